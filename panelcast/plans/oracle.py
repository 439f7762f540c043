"""The registered queries in plain SQL, for comparison by another engine.

Each query is built from named subqueries; only those it needs go into its WITH clause.
"""

from __future__ import annotations

import re

from panelcast.plans import panel_plan as plan
from panelcast.operators.scan import STATS
from panelcast.plans.roles import LAST_SETLIST, PARAMS

ORDER = "showdate, showid"
SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
PAST = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
SQL_STATS = {"min": "min", "max": "max", "avg": "avg", "median": "median"}


def over(cols, order: str = ORDER, frame: str = "") -> str:
    part = f"PARTITION BY {', '.join(cols)} " if cols else ""
    return f"OVER ({part}ORDER BY {order} {frame})"


def season(day: str) -> str:
    md = f"(month({day}) * 100 + day({day}))"
    return (
        f"CASE WHEN {md} <= 105 THEN 0 WHEN {md} <= 321 THEN 1 WHEN {md} <= 620 THEN 2 "
        f"WHEN {md} <= 922 THEN 3 WHEN {md} <= 1220 THEN 4 WHEN {md} <= 1226 THEN 1 ELSE 0 END"
    )


def _map_case(col: str, mapping: dict) -> str:
    return f"CASE {col} " + " ".join(f"WHEN {k} THEN {v}" for k, v in mapping.items()) + f" ELSE {col} END"


def _stats(value: str, cols, order: str, names: dict) -> list[str]:
    return [f"{SQL_STATS[s]}({value}) {over(cols, order, SO_FAR)} AS {n}" for s, n in names.items()]


CTES: dict[str, str] = {}

CTES["shows"] = """SELECT o_orderkey AS showid, CAST(o_orderdate AS DATE) AS showdate,
  CAST(year(o_orderdate) AS BIGINT) AS showyear, CAST(month(o_orderdate) AS BIGINT) AS showmonth,
  CAST(day(o_orderdate) AS BIGINT) AS showday,
  CASE WHEN c_acctbal < 0 THEN 2 ELSE 1 END AS artistid,
  CASE WHEN o_totalprice < 5000 THEN 1 ELSE 0 END AS exclude_from_stats, o_custkey AS venueid,
  CAST(CASE WHEN o_orderstatus = 'P' THEN 61 WHEN o_orderpriority <> '5-LOW'
    THEN year(o_orderdate) * 10 + quarter(o_orderdate) END AS BIGINT) AS tourid,
  c_name AS venue, n_name AS city, CASE WHEN c_mktsegment <> 'MACHINERY' THEN n_name END AS state,
  r_name AS country
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey"""
CTES["elig"] = """SELECT * REPLACE (coalesce(state, country) AS state) FROM shows
WHERE artistid = 1 AND exclude_from_stats = 0"""
CTES["hist"] = f"""SELECT *, row_number() {over(['venueid'])} - 1 AS num_show_venue,
  showdate - lag(showdate) {over(['venueid'])} AS time_since_last_venue,
  row_number() {over(['state'])} - 1 AS num_show_state,
  showdate - lag(showdate) {over(['state'])} AS time_since_last_state,
  row_number() {over([])} AS show_number,
  showdate - lag(showdate) {over([])} AS time_since_last_show FROM elig"""
CTES["starts"] = """SELECT *, CASE WHEN time_since_last_venue IS NULL OR time_since_last_venue > 120
  THEN 1 ELSE 0 END AS st FROM hist"""
CTES["numbered"] = """SELECT *, CASE WHEN st = 1 THEN
  row_number() OVER (PARTITION BY st ORDER BY showdate, venueid, showid) - 1 END AS rn FROM starts"""
CTES["inrun"] = f"""SELECT * EXCLUDE (st, rn), last_value(rn IGNORE NULLS) {over([], ORDER, SO_FAR)} AS runid
FROM numbered"""
CTES["keyed"] = """SELECT *, CASE WHEN tourid IS NOT NULL AND tourid <> 61 THEN 'T' || tourid
  ELSE 'R' || runid END AS pk FROM inrun"""
CTES["pnum"] = """SELECT pk, row_number() OVER (ORDER BY d, i) - 1 AS new_tourid FROM (
  SELECT pk, showdate AS d, showid AS i FROM keyed
  QUALIFY row_number() OVER (PARTITION BY pk ORDER BY showdate, showid) = 1)"""
CTES["placed"] = """SELECT * EXCLUDE (pk),
  row_number() OVER (PARTITION BY runid ORDER BY showdate, showid) - 1 AS current_run_venue,
  min(showdate) OVER (PARTITION BY new_tourid) AS first_day,
  max(showdate) OVER (PARTITION BY new_tourid) AS last_day,
  row_number() OVER (PARTITION BY tourid ORDER BY showdate, showid) AS tour_number
FROM keyed JOIN pnum USING (pk)"""
CTES["occ"] = f"""SELECT showid, showdate, venueid, tourid, new_tourid, runid, state, showyear, showmonth,
  showday, num_show_venue, coalesce(time_since_last_venue, -1) AS time_since_last_venue,
  current_run_venue, num_show_state, coalesce(time_since_last_state, -1) AS time_since_last_state,
  coalesce(time_since_last_show, -1) AS time_since_last_show, show_number,
  abs(showdate - last_day) AS days_left_on_tour, CAST({season('showdate')} AS BIGINT) AS season,
  CAST({season('first_day')} AS BIGINT) AS tour_season, showdate - first_day AS days_on_tour,
  CASE WHEN tourid IS NULL THEN current_run_venue ELSE tour_number END AS tour_show_number,
  CAST(isodow(showdate) - 1 AS BIGINT) AS day_of_week,
  showdate - DATE '1983-10-01' AS time_since_formation FROM placed"""
CTES["brands"] = "SELECT *, CAST(split_part(p_brand, '#', 2) AS BIGINT) AS songid FROM part"
CTES["sets"] = f"""SELECT l_orderkey AS showid, songid, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS is_original,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS isjamchart, {', '.join(PARAMS.source_order)}
FROM lineitem JOIN brands ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
WHERE CAST(o_orderdate AS DATE) <= DATE '{LAST_SETLIST}'"""
CTES["songs"] = """SELECT songid, p_brand AS song, p_type AS artist FROM brands
QUALIFY row_number() OVER (PARTITION BY songid ORDER BY p_partkey) = 1"""
CTES["releases"] = """SELECT songid, p_partkey AS albumid,
  DATE '1995-01-01' + CAST(p_partkey % 2400 AS INTEGER) AS releasedate, p_type, p_size FROM brands"""
CTES["albums"] = """SELECT songid, albumid, releasedate FROM releases WHERE p_type = 'PROMO' AND p_size <= 10"""
CTES["dedup"] = f"""SELECT o.showid, showdate, showyear, venueid, new_tourid, runid, state, songid, is_original,
  isjamchart FROM occ o JOIN sets s ON o.showid = s.showid
QUALIFY row_number() OVER (PARTITION BY o.showid, songid ORDER BY {', '.join(PARAMS.source_order)}) = 1"""
CTES["nums"] = f"""SELECT showid, row_number() {over([])} - 1 AS show_nm
FROM (SELECT DISTINCT showid, showdate FROM dedup)"""
CTES["yrs"] = f"""SELECT showyear, {_map_case('p', PARAMS.previous_year)} AS prev_year FROM (
  SELECT showyear, lag(showyear) OVER (ORDER BY showyear) AS p FROM (SELECT DISTINCT showyear FROM dedup))"""
CTES["trs"] = """SELECT new_tourid, lag(new_tourid) OVER (ORDER BY new_tourid) AS prev_tourid
FROM (SELECT DISTINCT new_tourid FROM dedup)"""
CTES["plays"] = """SELECT showid, songid, showdate, showyear, venueid, new_tourid, runid, state, show_nm,
  prev_year, prev_tourid, isjamchart,
  CASE WHEN is_original = 0 AND songid NOT IN (SELECT songid FROM albums) AND songid NOT IN
    (SELECT songid FROM songs WHERE artist IN ('LARGE', 'PROMO')) THEN 1 ELSE 0 END AS is_cover
FROM dedup JOIN nums USING (showid) JOIN yrs USING (showyear) JOIN trs USING (new_tourid)"""
_gaps = ", ".join(
    f"row_number() {over([*cols, 'songid'])} AS num_times_played_song{s}, "
    f"showdate - lag(showdate) {over([*cols, 'songid'])} AS gap_song{s}"
    for s, cols in plan.SCOPES.items()
)
CTES["gaps"] = f"SELECT *, {_gaps}, show_nm - lag(show_nm) {over(['songid'])} AS show_gap_song FROM plays"
_pf = [
    x for s, cols in plan.SCOPES.items()
    for x in _stats(f"gap_song{s}", [*cols, "songid"], ORDER, {k: f"{k}_gap_song{s}" for k in STATS})
] + _stats("show_gap_song", ["songid"], ORDER, {k: f"{k}_show_gap_song" for k in STATS})
CTES["pf"] = "SELECT *, " + ", ".join(_pf) + " FROM gaps"
CTES["jgaps"] = f"""SELECT showid, songid, showdate, showyear, new_tourid, show_nm, isjamchart,
  row_number() {over(['songid'])} AS num_times_jammed_song,
  show_nm - lag(show_nm) {over(['songid'])} AS show_gap_j_song FROM plays WHERE isjamchart = 1"""
CTES["jams"] = "SELECT *, " + ", ".join(
    _stats("show_gap_j_song", ["songid"], ORDER, {k: f"{k}_show_gap_j_song" for k in STATS})
) + " FROM jgaps"
CTES["known"] = f"SELECT DISTINCT {', '.join(plan.OCCASION_KEYS)}, showyear FROM plays"
CTES["newest"] = """SELECT max(showdate) AS d, max(show_nm) AS n, max(showyear) AS y, max(prev_year) AS py,
  max(new_tourid) AS t, max(prev_tourid) AS pt FROM (SELECT * FROM known
  QUALIFY row_number() OVER (PARTITION BY showdate ORDER BY showid DESC) = 1)"""
CTES["pocc"] = """SELECT showid, showdate, new_tourid, state, venueid, runid, prev_year, prev_tourid, show_nm,
  0 AS is_next FROM known UNION ALL (
SELECT showid, showdate, new_tourid, state, venueid, runid,
  CASE WHEN showyear = y THEN py ELSE y END, CASE WHEN new_tourid = t THEN pt ELSE t END, n + 1, 1
FROM occ, newest WHERE showdate > d ORDER BY showdate, showid LIMIT 1)"""
CTES["first_plays"] = "SELECT songid, min(showdate) AS song_debut_date FROM plays GROUP BY songid"
CTES["bare"] = "SELECT * FROM pocc JOIN first_plays ON showdate >= song_debut_date"
_play_cols = [f"num_times_played_song{s}" for s in plan.SCOPES] + [
    f"{k}_gap_song{s}" for s in plan.SCOPES for k in STATS
] + [f"{k}_show_gap_song" for k in STATS]
_jam_cols = ["num_times_jammed_song"] + [f"{k}_show_gap_j_song" for k in STATS]
CTES["frame"] = f"""SELECT b.*, CASE WHEN p.showid IS NULL THEN 0 ELSE 1 END AS played,
  CASE WHEN p.showid IS NOT NULL THEN b.showdate END AS played_day, p.showyear AS played_year,
  p.show_nm AS played_nm, CASE WHEN j.showid IS NULL THEN 0 ELSE 1 END AS isjamchart,
  j.showyear AS jam_year, j.show_nm AS jam_nm, {', '.join('p.' + c for c in _play_cols)},
  {', '.join('j.' + c for c in _jam_cols)}
FROM bare b LEFT JOIN pf p ON b.showid = p.showid AND b.songid = p.songid
  LEFT JOIN jams j ON b.showid = j.showid AND b.songid = j.songid"""


def _before(col: str, cols) -> str:
    return f"last_value({col} IGNORE NULLS) {over(cols, ORDER, PAST)}"


_rec = []
for _s, _cols in plan.SCOPES.items():
    _keys = [*_cols, "songid"]
    _rec.append(f"showdate - {_before('played_day', _keys)} AS time_last_played_song{_s}")
    _rec.append(f"{_before(f'num_times_played_song{_s}', _keys)} AS num_times_played_song{_s}")
    _rec += [
        f"coalesce({_before(f'{k}_gap_song{_s}', _keys)}, showdate - {_before('played_day', _keys)}) "
        f"AS {k}_gap_song{_s}" for k in STATS
    ]
_gap = f"show_nm - {_before('played_nm', ['songid'])}"
_rec += [
    f"{_gap} AS show_gap",
    f"show_nm - {_before('jam_nm', ['songid'])} AS show_jam_gap",
    f"CASE WHEN {_before('played_year', ['songid'])} >= prev_year THEN 1 ELSE 0 END AS played_in_last_year",
    f"CASE WHEN {_before('jam_year', ['songid'])} >= prev_year THEN 1 ELSE 0 END AS jammed_in_last_year",
    f"coalesce({_before('num_times_jammed_song', ['songid'])}, 0) AS n_times_jammed_song",
    "showdate - song_debut_date AS time_since_song_debut",
]
_rec += [
    f"coalesce({_before(f'{k}_{v}', ['songid'])}, {_gap}) AS {k}_{v}"
    for v in ("show_gap_song", "show_gap_j_song") for k in STATS
]
CTES["rec"] = f"""SELECT {', '.join(plan.OCCASION_KEYS)}, is_next, songid, song_debut_date, played, isjamchart,
  {', '.join(_rec)} FROM frame"""
CTES["trail_days"] = """SELECT songid, showdate, sum(played) AS p, count(*) AS n, sum(isjamchart) AS j,
  sum(CASE WHEN played = 1 THEN show_gap END) AS g, count(CASE WHEN played = 1 THEN show_gap END) AS gn,
  sum(CASE WHEN isjamchart = 1 THEN show_jam_gap END) AS h,
  count(CASE WHEN isjamchart = 1 THEN show_jam_gap END) AS hn FROM rec GROUP BY songid, showdate"""
_months = "".join(f"WHEN {y} THEN {m} " for y, m in PARAMS.trailing_overrides.items())
CTES["trail"] = f"""SELECT a.songid, a.showdate, sum(b.p) / sum(b.n) AS rate_played_this_year,
  sum(b.j) / sum(b.n) AS rate_jammed_this_year,
  CAST(coalesce(sum(b.p), 0) AS BIGINT) AS tot_times_played_in_last_year,
  CAST(coalesce(sum(b.j), 0) AS BIGINT) AS tot_times_jammed_in_last_year,
  sum(b.g) / nullif(sum(b.gn), 0) AS avg_gap_year, sum(b.h) / nullif(sum(b.hn), 0) AS avg_jam_gap_year
FROM trail_days a LEFT JOIN trail_days b ON a.songid = b.songid AND b.showdate < a.showdate
  AND b.showdate >= a.showdate - to_months(CASE year(a.showdate) {_months}ELSE 12 END)
GROUP BY a.songid, a.showdate"""
CTES["album_nums"] = """SELECT albumid, row_number() OVER (ORDER BY releasedate, albumid) - 1 AS album_num
FROM (SELECT albumid, min(releasedate) AS releasedate FROM albums GROUP BY albumid)"""
CTES["numbered_albums"] = "SELECT * FROM albums JOIN album_nums USING (albumid)"
CTES["cover_flags"] = f"""SELECT songid, is_cover FROM plays
QUALIFY row_number() OVER (PARTITION BY songid ORDER BY {ORDER}) = 1"""
CTES["dated"] = """SELECT r.*, t.* EXCLUDE (songid, showdate), a.album_num, c.is_cover FROM rec r
JOIN trail t ON r.songid = t.songid AND r.showdate = t.showdate
LEFT JOIN cover_flags c ON r.songid = c.songid
ASOF LEFT JOIN numbered_albums a ON r.songid = a.songid AND r.showdate >= a.releasedate"""
CTES["flagged"] = f"""SELECT *, CASE WHEN ok AND rk <= {PARAMS.notebook_size} THEN 1 ELSE 0 END AS notebook_flag
FROM (SELECT *, row_number() OVER (PARTITION BY showid, ok ORDER BY tot_times_played_in_last_year DESC, songid)
  AS rk FROM (SELECT *, coalesce(tot_times_played_in_last_year > 0 AND show_gap > {PARAMS.notebook_gap}, false)
  AS ok FROM dated))"""
for _s, _cols in plan.TOUR_SCOPES.items():
    _k = ", ".join(["songid", *_cols])
    _value, _names = plan._tour_names("num_times_song_played", _s)
    CTES[f"spine{_s}"] = f"""SELECT s.*, coalesce(n, 0) AS {_value} FROM
  (SELECT DISTINCT prev_tourid, {_k} FROM frame WHERE prev_tourid IS NOT NULL) s LEFT JOIN
  (SELECT new_tourid AS prev_tourid, {_k}, count(*) AS n FROM plays GROUP BY ALL) c
  USING (prev_tourid, {_k})"""
    CTES[f"counts{_s}"] = "SELECT *, " + ", ".join(
        _stats(_value, ["songid", *_cols], "prev_tourid", _names)
    ) + f" FROM spine{_s}"
    _value, _names = plan._tour_names("rate_song_played", _s)
    CTES[f"tour_rates{_s}"] = f"""SELECT new_tourid AS prev_tourid, {_k}, avg(played) AS {_value}
  FROM frame GROUP BY ALL"""
    CTES[f"rates{_s}"] = "SELECT *, " + ", ".join(
        _stats(_value, ["songid", *_cols], "prev_tourid", _names)
    ) + f" FROM tour_rates{_s}"
for _name, _src, _p, _prev, _v, _n in (
    ("year_plays", "gaps", "showyear", "prev_year", "show_gap_song", plan.YEAR_PLAYS),
    ("tour_plays", "gaps", "new_tourid", "prev_tourid", "show_gap_song", plan.TOUR_PLAYS),
    ("year_jams", "jgaps", "showyear", "prev_year", "show_gap_j_song", plan.YEAR_JAMS),
    ("tour_jams", "jgaps", "new_tourid", "prev_tourid", "show_gap_j_song", plan.TOUR_JAMS),
):
    CTES[_name] = f"SELECT songid, {_p} AS {_prev}, " + ", ".join(
        f"{SQL_STATS[k]}({_v}) AS {n}" for k, n in _n.items()
    ) + f" FROM {_src} GROUP BY songid, {_p}"
CTES["feats"] = f"""SELECT showid, songid, is_next, played, {', '.join(plan.feature_names())} FROM flagged
LEFT JOIN counts USING (prev_tourid, songid) LEFT JOIN rates USING (prev_tourid, songid)
LEFT JOIN counts_state USING (prev_tourid, songid, state) LEFT JOIN rates_state USING (prev_tourid, songid, state)
LEFT JOIN counts_venue USING (prev_tourid, songid, venueid) LEFT JOIN rates_venue USING (prev_tourid, songid, venueid)
LEFT JOIN year_plays USING (prev_year, songid) LEFT JOIN tour_plays USING (prev_tourid, songid)
LEFT JOIN year_jams USING (prev_year, songid) LEFT JOIN tour_jams USING (prev_tourid, songid)
WHERE time_since_song_debut > 0"""
CTES["split"] = "SELECT showid, songid, is_next, played, " + ", ".join(
    f"coalesce({c}, -1) AS {c}" for c in plan.feature_names()
) + " FROM feats"
CTES["venues_raw"] = """SELECT c_custkey AS venueid, CASE c_mktsegment WHEN 'BUILDING' THEN 'Unknown'
  ELSE c_mktsegment END AS venuename, CASE n_name WHEN 'NATION_1' THEN 'NATION_2' ELSE n_name END AS city,
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'S-' || n_name END AS state, r_name AS country, c_acctbal
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE n_name <> 'NATION_3'"""
CTES["venue_keys"] = """SELECT *, CASE WHEN venuename = 'Unknown' THEN '' ELSE venuename || ', ' END || city || ', '
  || CASE WHEN state IS NULL THEN '' ELSE state || ', ' END || country AS lookup_id,
  city || ', ' || CASE WHEN state IS NULL THEN '' ELSE state || ', ' END || country AS lookup_id2
FROM venues_raw"""
CTES["gaz_all"] = """SELECT lookup_id AS place, min(c_acctbal) AS latitude, max(c_acctbal) AS longitude
FROM venue_keys WHERE c_acctbal > 5000 GROUP BY lookup_id UNION ALL
SELECT n_name || ', S-' || n_name || ', ' || r_name, n_nationkey * 3.0 - 40, n_nationkey * 5.0 - 60
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey > 5"""
CTES["gaz"] = """SELECT * FROM gaz_all QUALIFY row_number() OVER (PARTITION BY place ORDER BY latitude, longitude) = 1"""
CTES["located"] = """SELECT venueid, lookup_id, lookup_id2,
  CASE WHEN a.place IS NOT NULL THEN a.latitude ELSE b.latitude END AS latitude,
  CASE WHEN a.place IS NOT NULL THEN a.longitude ELSE b.longitude END AS longitude
FROM venue_keys LEFT JOIN gaz a ON lookup_id = a.place LEFT JOIN gaz b ON lookup_id2 = b.place"""
CTES["full_rows"] = f"""SELECT s.*, o.new_tourid, {', '.join('o.' + c for c in plan.SHOW_FEATURES)}, latitude, longitude
FROM split s LEFT JOIN occ o USING (showid) LEFT JOIN located USING (venueid)
WHERE is_next = 1 OR latitude IS NOT NULL"""
CTES["supported"] = f"""SELECT songid FROM full_rows WHERE is_next = 0 GROUP BY songid
HAVING sum(played) >= {PARAMS.min_support}"""
CTES["analytical"] = "SELECT * FROM full_rows WHERE songid IN (SELECT songid FROM supported)"

_MENTION = {name: re.compile(rf"\b{name}\b") for name in CTES}


def sql(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind the subqueries that it mentions, directly or not, in order of definition."""
    texts = {**CTES, **(extra or {})}
    mention = {**_MENTION, **{n: re.compile(rf"\b{n}\b") for n in (extra or {})}}
    needed, queue = set(), [body]
    while queue:
        text = queue.pop()
        for name, pattern in mention.items():
            if name not in needed and texts[name] is not text and pattern.search(text):
                needed.add(name)
                queue.append(texts[name])
    parts = [f"{n} AS MATERIALIZED (\n{t}\n)" for n, t in texts.items() if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def whole(*cols: str, prefix: str = "") -> str:
    return ", ".join(f"CAST({prefix}{c} AS BIGINT) AS {c}" for c in cols)


def real(*cols: str, prefix: str = "") -> str:
    return ", ".join(f"{six_digits(prefix + c)} AS {c}" for c in cols)


def six_digits(c: str) -> str:
    return f"floor(CAST({c} AS DOUBLE) * 1e6 + 0.5001) / 1e6"
