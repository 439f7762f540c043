"""The registered queries on splits, preprocessing, models and scores."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions import columns as C
from panelcast.models.discriminant import Discriminant
from panelcast.operators import ml as M
from panelcast.params import ModelParams
from panelcast.plans import oracle as Q
from panelcast.plans import panel_plan as P
from panelcast.plans import roles as R
from panelcast.plans.digest import moments
from panelcast.plans.oracle import sql, whole
from panelcast.plans.queries import analytical, build, profile, profile_sql, query, tidy
from panelcast.runtime import cut_lineage

SETS: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}

# What the prepared rows and the models beside the forest start from. Registered models other than the
# forest are smaller than their defaults, which take too long for a check: see the README.
MODEL = ModelParams(start=1995, cut=2000, last_groups=3)


def stored_sets(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The analytical sets, written once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in SETS:
        past, ahead = analytical(spark, sf)
        SETS[key] = cut_lineage(past), cut_lineage(ahead)
    return SETS[key]


_ROWS = "SELECT * FROM analytical WHERE is_next = 0"


@query("time_split", sql(f"SELECT {whole('showid', 'songid', 'showyear', 'played')} FROM ({_ROWS}) WHERE showyear >= 1996 AND showyear < 2000"))
def _(spark, sf):
    rows = M.time_split(stored_sets(spark, sf)[0], "showyear", 1996, 2000)
    return tidy(rows, "showid", "songid", "showyear", "played")


@query("sliding_split", sql(f"""SELECT {whole('showid', 'songid', 'showyear')} FROM ({_ROWS}) WHERE showyear IN
  (SELECT DISTINCT showyear FROM ({_ROWS}) ORDER BY showyear DESC LIMIT 3)"""))
def _(spark, sf):
    return tidy(M.last_n_groups(stored_sets(spark, sf)[0], "showyear", 3), "showid", "songid", "showyear")


_MODEL_FEATURES = [*P.feature_names(), *[c for c in P.SHOW_FEATURES if c != "showyear"], "latitude", "longitude"]


@query("feature_vector", sql(f"""SELECT {whole('showid', 'songid')}, CAST({len(_MODEL_FEATURES)} AS BIGINT) AS width,
  {Q.six_digits(' + '.join(f'CAST({c} AS DOUBLE)' for c in _MODEL_FEATURES))} AS total FROM ({_ROWS})"""))
def _(spark, sf):
    rows = C.cast_features(stored_sets(spark, sf)[0], "played")
    cols = C.feature_columns(rows, ["showid", "songid", "new_tourid", "played", "showyear"])
    vectors = M.assemble(rows, cols, ["showid", "songid"]).withColumn("x", M.vector_to_array(M.FEATURES))
    total = F.aggregate("x", F.lit(0.0), lambda acc, v: acc + v)
    return tidy(vectors.select(
        F.col("showid").cast("long"), F.col("songid").cast("long"), F.size("x").alias("width"), total.alias("total")
    ))


_SCALED = ["show_gap", "time_last_played_song", "num_times_played_song", "latitude"]


@query("standardise", sql(f"""SELECT {whole('showid', 'songid', 'is_next')}, {', '.join(
    Q.six_digits(f'((CAST({c} AS DOUBLE) - m_{c}) / s_{c})') + f' AS {c}' for c in _SCALED)}
FROM analytical, (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in _SCALED)}
  FROM ({_ROWS}))"""))
def _(spark, sf):
    past, ahead = (df.select("showid", "songid", *_SCALED) for df in stored_sets(spark, sf))
    past, ahead = M.standardise(past, [ahead], _SCALED)
    both = past.withColumn("is_next", F.lit(0)).unionByName(ahead.withColumn("is_next", F.lit(1)))
    return tidy(both)


@query("variance_select", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature FROM (SELECT *, 1 AS always FROM ({_ROWS})) HAVING min({c}) < max({c})"
    for c in [*_MODEL_FEATURES, "always"])))
def _(spark, sf):
    rows = stored_sets(spark, sf)[0].withColumn("always", F.lit(1))
    kept = M.variance_select(rows, [*_MODEL_FEATURES, "always"])
    return spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in kept])).alias("feature"))


# The training rows as every model gets them, in SQL: scaled, and each with its copies.
_SCALE = ", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in _MODEL_FEATURES)
_SCALED_ALL = ", ".join(f"(CAST(coalesce({c}, -1) AS DOUBLE) - m_{c}) / s_{c} AS {c}" for c in _MODEL_FEATURES)
PREPARED = {
    "train_rows": f"{_ROWS} AND showyear >= {MODEL.start}",
    "scales": f"SELECT {_SCALE} FROM train_rows",
    "train_scaled": f"SELECT {whole('showid', 'songid', 'played')}, {_SCALED_ALL} FROM train_rows, scales",
    "ahead_scaled": f"SELECT {whole('showid', 'songid')}, {_SCALED_ALL} FROM analytical, scales WHERE is_next = 1 AND showyear >= {MODEL.start}",
    "class_sizes": "SELECT *, max(n) OVER () - n AS missing FROM (SELECT played, count(*) AS n FROM train_rows GROUP BY played)",
    "drawn": f"""SELECT played, ordinal, count(*) AS times FROM (
  SELECT played, CAST('0x' || substr(md5('{MODEL.seed}|draw|' || CAST(played AS BIGINT) || '|' || i), 1, 15) AS BIGINT) % n + 1 AS ordinal
  FROM (SELECT *, unnest(range(CAST(missing AS BIGINT))) AS i FROM class_sizes)) GROUP BY ALL""",
    "copied": f"""SELECT showid, songid, r.played, 1 + coalesce(times, 0) AS copies FROM (
  SELECT {whole('showid', 'songid')}, played, row_number() OVER (PARTITION BY played
    ORDER BY md5('{MODEL.seed}|' || CAST(showid AS BIGINT) || '|' || CAST(songid AS BIGINT))) AS ordinal FROM train_rows) r
  LEFT JOIN drawn d ON r.played = d.played AND r.ordinal = d.ordinal""",
    "prepared": "SELECT t.*, copies FROM train_scaled t JOIN copied USING (showid, songid)",
}


@query("oversample", sql(f"SELECT {whole('showid', 'songid', 'played', 'copies')} FROM copied", PREPARED))
def _(spark, sf):
    rows = stored_sets(spark, sf)[0].select("showid", "songid", "played")
    balanced = M.oversample(rows, "played", ["showid", "songid"], MODEL.seed)
    return tidy(balanced.groupBy("showid", "songid", "played").agg(F.count(F.lit(1)).alias("copies")))


@query("prepared_rows", sql(" UNION ALL ".join(
    f"""SELECT CAST(played AS BIGINT) AS played, '{c}' AS feature, CAST(sum(copies) AS BIGINT) AS n,
  {Q.six_digits(f'sum(copies * {c}) / sum(copies)')} AS average, {Q.six_digits(f'sum(copies * {c} * {c}) / sum(copies)')} AS square,
  {Q.six_digits(f'min({c})')} AS low, {Q.six_digits(f'max({c})')} AS high FROM prepared GROUP BY played
  HAVING (SELECT min({c}) < max({c}) FROM train_rows)"""
    for c in _MODEL_FEATURES), PREPARED))
def _(spark, sf):
    """What a classifier learns from, per class and selected feature: rows, mean, mean square, extremes."""
    past = stored_sets(spark, sf)[0]
    stages, rows = M.classifier(past, MODEL).prepared(M.training_rows(past, MODEL))
    names = stages[-1].getInputCols()
    return tidy(moments(rows, "played", M.vector_to_array(M.FEATURES), list(names)))


_NEAR = ["show_gap", "num_times_played_song_venue", "tot_times_played_in_last_year", "time_last_played_song_state"]


@query("knn_vote", sql(f"""SELECT CAST(songid AS BIGINT) AS songid, {Q.six_digits('avg(y)')} AS y_pred_proba FROM (
  SELECT t.songid, a.played AS y, row_number() OVER (PARTITION BY t.songid ORDER BY
    {' + '.join(f'power(CAST(a.{c} AS DOUBLE) - CAST(t.{c} AS DOUBLE), 2)' for c in _NEAR)}, a.showid, a.songid) AS rk
  FROM ({_ROWS}) a, (SELECT * FROM analytical WHERE is_next = 1) t) WHERE rk <= 5 GROUP BY songid"""))
def _(spark, sf):
    past, ahead = stored_sets(spark, sf)
    return tidy(M.knn_vote(past, ahead, _NEAR, "played", ["showid", "songid"], ["songid"], 5))


@query("score_report", sql("""SELECT CAST(d.showid AS BIGINT) AS showid, CAST(d.songid AS BIGINT) AS songid, venue, city, s.state,
  country, strftime(s.showdate, '%m/%d/%Y') AS showdate, song, floor(CAST(rate_played_this_year AS DOUBLE) * 1e6 + 0.5001) / 1e6
  AS probability FROM dated d LEFT JOIN songs g ON d.songid = g.songid LEFT JOIN shows s ON d.showid = s.showid
WHERE rate_played_this_year > 0.17"""))
def _(spark, sf):
    rated = P.played_rate(build(spark, sf).outcomes, R.PARAMS)
    scores = rated.select("songid", "showid", F.col("rate_played_this_year").alias(M.PROBA))
    return tidy(M.score_report(scores, R.songs(spark, sf), R.shows(spark, sf), 0.17))


def _score_query(name: str, model: str, oracle: str | None = None, **options):
    def run(spark, sf):
        # the forest is the selected model: all of its trees and rows
        params = ModelParams() if model == "rf" else replace(MODEL, model=model, options=options)
        return tidy(M.fit_and_score(*stored_sets(spark, sf), params))

    query(name, oracle)(run)


def _posterior(apart: str) -> str:
    """The probability of class 1 from the log odds against it."""
    return Q.six_digits(f"(1 / (1 + exp(greatest(least({apart}, 700), -700))))")


_FLAGS = ", ".join(f"sum(CASE WHEN {c} > 0 THEN copies ELSE 0 END) AS {c}" for c in _MODEL_FEATURES)
_BERNOULLI = " + ".join(
    f"CASE WHEN t.{c} > 0 THEN ln((z.{c} + 1) / (z.n + 2)) - ln((o.{c} + 1) / (o.n + 2)) "
    f"ELSE ln(1 - (z.{c} + 1) / (z.n + 2)) - ln(1 - (o.{c} + 1) / (o.n + 2)) END" for c in _MODEL_FEATURES
)
_SQUARES = ", ".join(f"sum(copies * {c}) / sum(copies) AS a_{c}, sum(copies * {c} * {c}) / sum(copies) AS q_{c}" for c in _MODEL_FEATURES)
_LARGEST = ", ".join(f"(z.q_{c} + o.q_{c}) / 2 - power((z.a_{c} + o.a_{c}) / 2, 2)" for c in _MODEL_FEATURES)
_NORMAL = " + ".join(
    f"(power(t.{c} - o.a_{c}, 2) / (o.q_{c} - o.a_{c} * o.a_{c} + e) + ln(o.q_{c} - o.a_{c} * o.a_{c} + e) "
    f"- power(t.{c} - z.a_{c}, 2) / (z.q_{c} - z.a_{c} * z.a_{c} + e) - ln(z.q_{c} - z.a_{c} * z.a_{c} + e)) / 2" for c in _MODEL_FEATURES
)
_FAR = " + ".join(f"(a.{c} - t.{c}) * (a.{c} - t.{c})" for c in _MODEL_FEATURES)

_score_query("score_next", "rf")
_score_query("score_boosted_trees", "gbf", n_estimators=5)
_score_query("score_boosted_trees_deep", "xgbl", n_estimators=3)
# both classes have as many rows once balanced, so their priors are equal
_score_query("score_bernoulli_bayes", "bb", sql(f"""SELECT t.showid, t.songid, {_posterior(_BERNOULLI)} AS y_pred_proba
FROM ahead_scaled t, (SELECT * FROM flagged_sums WHERE played = 0) z, (SELECT * FROM flagged_sums WHERE played = 1) o""", {
    **PREPARED, "flagged_sums": f"SELECT played, CAST(sum(copies) AS DOUBLE) AS n, {_FLAGS} FROM prepared GROUP BY played"}))
_score_query("score_gaussian_bayes", "gb", sql(f"""SELECT t.showid, t.songid, {_posterior(_NORMAL)} AS y_pred_proba
FROM ahead_scaled t, zeros z, ones o, (SELECT 1e-9 * greatest({_LARGEST}) AS e FROM zeros z, ones o)""", {
    **PREPARED, "class_squares": f"SELECT played, {_SQUARES} FROM prepared GROUP BY played",
    "zeros": "SELECT * FROM class_squares WHERE played = 0", "ones": "SELECT * FROM class_squares WHERE played = 1"}))
_score_query("score_linear_discriminant", "lda")
_score_query("score_shrunk_discriminant", "lda_shrink")
_score_query("score_quadratic_discriminant", "qda")
_score_query("score_boosted_stumps", "ada", n_estimators=5)
_score_query("score_neighbours", "knn", sql(f"""SELECT showid, songid, {Q.six_digits('avg(played)')} AS y_pred_proba FROM (
  SELECT *, row_number() OVER (PARTITION BY showid, songid ORDER BY far, near_show, near_song) AS rk FROM (
    SELECT t.showid, t.songid, a.showid AS near_show, a.songid AS near_song, a.played, unnest(range(least(copies, 5))), {_FAR} AS far
    FROM prepared a, ahead_scaled t)) WHERE rk <= 5 GROUP BY showid, songid""", PREPARED))


_PAIR = ("show_gap", "num_times_played_song_venue")


def _gap(k: str) -> str:
    """Squared distance to a class, and log volume, for two features."""
    x, y, det = f"(t.x - {k}.mx)", f"(t.y - {k}.my)", f"({k}.xx * {k}.yy - {k}.xy * {k}.xy)"
    return f"(({x} * {x} * {k}.yy - 2 * {x} * {y} * {k}.xy + {y} * {y} * {k}.xx) / {det} + ln({det}))"


@query("discriminant_pair", sql(f"""SELECT {whole('showid', 'songid', prefix='t.')},
  {_posterior(f'(ln(z.n / o.n) + ({_gap("o")} - {_gap("z")}) / 2)')} AS quadratic,
  {_posterior(f'(ln(z.n / o.n) + ({_gap("po")} - {_gap("pz")}) / 2)')} AS linear
FROM pair_rows t, (SELECT * FROM own WHERE played = 0) z, (SELECT * FROM own WHERE played = 1) o,
  (SELECT * FROM pooled WHERE played = 0) pz, (SELECT * FROM pooled WHERE played = 1) po WHERE is_next = 1""", {
    "pair_rows": f"SELECT showid, songid, is_next, played, CAST({_PAIR[0]} AS DOUBLE) AS x, CAST({_PAIR[1]} AS DOUBLE) AS y FROM analytical",
    "own": """SELECT played, CAST(count(*) AS DOUBLE) AS n, avg(x) AS mx, avg(y) AS my, var_samp(x) AS xx, var_samp(y) AS yy, covar_samp(x, y) AS xy
  FROM pair_rows WHERE is_next = 0 GROUP BY played""",
    "pooled": """SELECT played, mx, my, sum((n - 1) * xx) OVER () / (sum(n) OVER () - 2) AS xx, sum((n - 1) * yy) OVER () / (sum(n) OVER () - 2) AS yy,
  sum((n - 1) * xy) OVER () / (sum(n) OVER () - 2) AS xy FROM own"""}))
def _(spark, sf):
    """Both discriminants on two features of all rows, without preprocessing."""
    past, ahead = (M.assemble(df.select("showid", "songid", "played", *[F.col(c).cast("double").alias(c) for c in _PAIR]), _PAIR,
                              ["showid", "songid", "played"]) for df in stored_sets(spark, sf))
    linear = Discriminant("played", pooled=True).fit(past).transform(ahead).withColumnRenamed(M.PROBA, "linear")
    both = Discriminant("played", pooled=False).fit(past).transform(linear).withColumnRenamed(M.PROBA, "quadratic")
    return tidy(both, "showid", "songid", "linear", "quadratic")


@query("importance_select")
def _(spark, sf):
    rows = cut_lineage(M.training_rows(stored_sets(spark, sf)[0], MODEL))
    vectors = M.assemble(rows, _MODEL_FEATURES, ["played"])
    kept = [_MODEL_FEATURES[i] for i in M.importance_select(vectors, "played", MODEL.seed, 5, 5)]
    return spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in kept])).alias("feature"))
