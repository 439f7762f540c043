import random

import pytest
import xxhash

from panelcast.llm import simhash

IDS = "doc_id long, text string, source string"


def brute(rows, shingle, max_bits):
    """Definition: bit sums, all pairs, repeated merging."""
    prints = []
    for doc_id, text, *_ in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = lowered.encode().split()
        k = min(shingle, len(words))
        hs = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)] if words else []
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)))
    comp = [r[0] for r in rows]
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                    comp[i] = min(comp[i], comp[j])
    return sorted((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, comp))


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = ["the", "Of", "ÉTÉ", "naïve", "x", "word joined", "lorem", "IPSUM", "12", "-"]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(n // 3)]
    out = []
    for i in range(n):
        words = rng.choice(base).split(" ")
        if words and rng.random() < 0.5:
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append((i * 7 % 1009, rng.choice([" ", "\n", "\t \r"]).join(words), "s"))
    return out + [(2000, None, "s"), (2001, "", "s"), (2002, " \n\x0b ", None), (2003, "one", "s"), (2003, "one", "s")]


@pytest.mark.parametrize("bits", [2, 4, 9])
def test_components_equal_brute_force(spark, bits):
    rows = texts(bits, 90)
    got = simhash.near_duplicates(spark.createDataFrame(rows, IDS), 4, bits).drop("hash").collect()
    assert sorted(map(tuple, got)) == brute(rows, 4, bits)


def test_large_buckets_are_cut_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 8)
    rows = texts(5, 90)
    got = simhash.near_duplicates(spark.createDataFrame(rows, IDS), 4, 6).drop("hash").collect()
    assert sorted(map(tuple, got)) == brute(rows, 4, 6)


def test_every_choice_of_blocks_finds_all_pairs(spark, monkeypatch):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(40)]
    for f in list(fps):
        for bits in (1, 3, 4, 5):
            for b in rng.sample(range(64), bits):
                f ^= 1 << b
            fps.append(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp long, rep long")
    want = {(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4}
    for agree in (1, 2, 3, 4):
        monkeypatch.setattr(simhash, "agreeing_blocks", lambda n, bits, agree=agree: agree)
        links = {(max(r), min(r)) for r in simhash.near_fingerprints(df, 4).collect()}
        assert links <= want
        assert merged(links, len(fps)) == merged(want, len(fps))


def merged(links, n):
    root = list(range(n))
    for _ in range(n):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_empty_table_null_ids_and_other_columns(spark):
    schema = "doc_id long, text string, fp string, rep int, a int"
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "a b c", "x", 1, 2), (None, "only here", "x", 1, 2), (5, "a b c", None, None, None)]
    got = {(r[0], r[2]) for r in simhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()}
    assert got == {(None, 5), (None, None), (5, 5)}


def test_size_decides_only_the_number_of_blocks():
    assert [simhash.agreeing_blocks(n, 4) for n in (10, 10**6, 10**9, 10**11)] == [1, 2, 3, 4]
    assert len(simhash.block_masks(4, 2)) == 15
