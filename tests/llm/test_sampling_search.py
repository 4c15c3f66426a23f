"""Operators 11 to 13 against brute force: spelling variants, prefix forest, importance resampling."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from flightlens.llm import importance_resampling, prefix_forest, spelling_variants
from llm_fixtures import docs  # noqa: F401


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- 11 ----------------------------------------------------------------------

def plain_variants(rows, drop_every=97, min_length=5, min_count=3):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    out = {}
    for w, n in words.items():
        found = [x for x in words if near(w, x)]
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        out[w] = [form, None, n, len(found), words.get(form)]
    for w, row in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        row[1] = root
    return {w: tuple(row) for w, row in out.items()}


@pytest.mark.parametrize("drop_every", [3, 97])
def test_spelling_variants_equal_brute_force(docs, drop_every):
    rng = random.Random(2)
    letters = "abé×"
    base = ["aaaaa", "aaaaaa", "aabaa", "ababa", "abéab", "bbbbbb", "colour", "color", "colours", "colouur", "Colour"]
    base += ["".join(rng.choice(letters) for _ in range(rng.randint(4, 7))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(base[:20] if rng.random() < 0.5 else base) for _ in range(40))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "x1y2 Ā longĀword 𝔸bcdef"), (103, "aaaaa" * 9000), (5, rows[5][1]), (None, "colour colour aaaaa")]
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
           for r in spelling_variants.variants(docs(rows), drop_every=drop_every).collect()}
    want = plain_variants(rows, drop_every)
    assert len(want) > 40 and got == want
    assert spelling_variants.variants(docs([])).count() == 0
    assert spelling_variants.variants(docs([(1, "one two three")])).count() == 0


def test_runs_that_are_not_thinned(docs):
    got = {r["word"]: r["n"] for r in spelling_variants.variants(docs([(1, "seven Seven SEVEN eight")]), drop_every=None).collect()}
    assert got == {"seven": 3}


def test_chain_of_forms_ends_at_its_last(docs):
    text = " ".join(["aaaab"] * 3 + ["aaabb"] * 6 + ["aabbb"] * 12 + ["abbbb"] * 24 + ["bbbbb"] * 48)
    rows = spelling_variants.variants(docs([(1, text)]), drop_every=None).collect()
    assert {r["word"]: r["root"] for r in rows} == {w: "bbbbb" for w in ("aaaab", "aaabb", "aabbb", "abbbb", "bbbbb")}


# --- 12 ----------------------------------------------------------------------

def plain_nearest(rows, every, k):
    usable = [(i, np.array(v, float) / np.abs(np.array(v, float)).max()) for i, v in rows if i is not None and v and None not in v
              and np.isfinite(v).all() and any(v)]
    out = {}
    for i, q in usable:
        if i % every == 0:
            scores = [(-(q @ v) / math.sqrt((q @ q) * (v @ v)), j) for j, v in usable if j != i and len(v) == len(q)]
            out[i] = [(j, -s) for s, j in sorted((round(s, 12), j) for s, j in scores)][:k]
    return out


def vector_rows(n=900, dim=24, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return [(i, [float(x) for x in np.float32(centres[i % 12] + rng.normal(size=dim) * rng.choice([0.1, 0.3, 1.0]))]) for i in range(n)]


def test_forest_finds_the_nearest(spark, monkeypatch):
    monkeypatch.setattr(prefix_forest, "TILE", 64)
    monkeypatch.setattr(prefix_forest, "QUERY_TILE", 8)
    rows = vector_rows()
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    got = {}
    for r in prefix_forest.search(frame, 10, 5).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    want = plain_nearest(rows, 10, 5)
    assert set(got) == set(want) and all(sorted(x) == [1, 2, 3, 4, 5] for x in got.values())
    true = {i: dict(plain) for i, plain in plain_nearest(rows, 10, 900).items()}
    for i, found in got.items():
        assert all(abs(score - true[i][j]) < 1e-9 for j, score in found.values())
        order = [(-score, j) for _, (j, score) in sorted(found.items())]
        assert order == sorted(order)
    hits = sum(len({j for j, _ in got[i].values()} & {j for j, _ in want[i]}) for i in want)
    assert hits >= 0.9 * 5 * len(want)


def test_only_short_lists_of_units_are_broadcast(spark, monkeypatch):
    """Spark sizes the exploded rows of all trees as the table they come from; neither they nor the vectors are broadcast."""
    frame = spark.createDataFrame(vector_rows(), "vec_id long, embedding array<float>")
    plans, compare, stored = [], prefix_forest.compare, prefix_forest.stored

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def kept(df, name):
        if name == "forest-units":
            plans.append(plan(df))
        return stored(df, name)

    def seen(*args):
        out = compare(*args)
        plans.append(plan(out))
        return out

    monkeypatch.setattr(prefix_forest, "stored", kept)
    monkeypatch.setattr(prefix_forest, "compare", seen)
    few = sorted(map(tuple, prefix_forest.search(frame, 10, 5).collect()))
    units, dealt = plans[0::2], plans[1::2]
    assert units and all("SortMergeJoin [dim" in p and "BroadcastHashJoin [dim" not in p for p in units)
    assert all("SortMergeJoin [cid" in p and "BroadcastHashJoin [dim" in p for p in dealt)
    del plans[:]
    monkeypatch.setattr(prefix_forest, "BROADCAST_UNITS", 0)
    assert sorted(map(tuple, prefix_forest.search(frame, 10, 5).collect())) == few
    assert plans and all("BroadcastHashJoin [dim" not in p for p in plans)


def test_forest_defined_results(spark):
    """Copies, scaled copies, nulls and extreme values; with so few vectors every query ends at the whole table."""
    rng = np.random.default_rng(4)
    base = [[float(x) for x in rng.normal(size=8)] for _ in range(4)]
    rows = [(0, base[0]), (1, base[0]), (2, base[0]), (3, base[0]), (4, base[0]), (5, base[0]), (6, base[0]), (50, base[0]),
            (50, base[0]), (7, base[1]), (8, [x * 1e200 for x in base[1]]), (100, [x * 1e-200 for x in base[1]]), (9, base[2]),
            (10, None), (150, [0.0] * 8), (200, [float("nan")] * 8), (11, [None] + base[0][1:]), (12, []), (250, base[0][:3]),
            (None, base[0]), (13, [float("inf")] * 8), (300, base[3])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in prefix_forest.search(frame).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == {0, 50, 100, 300}
    assert [j for j, _ in got[0]] == [1, 2, 3, 4, 5] and [j for j, _ in got[50]] == [0, 1, 2, 3, 4]
    assert all(abs(s - 1) < 1e-12 for _, s in got[0] + got[50] + got[100][:2])
    assert {j for j, _ in got[100][:2]} == {7, 8}
    assert len(got[300]) == 5
    assert prefix_forest.search(frame.limit(0)).count() == 0
    assert prefix_forest.search(frame.where("vec_id = 7")).count() == 0


def test_hash_strings_do_not_depend_on_length_or_batch():
    x = np.random.default_rng(1).normal(size=(50, 40))
    codes = prefix_forest.strings(x)
    assert (codes == prefix_forest.strings(x * 2.0 ** 300)).all()
    assert (codes[7:9] == prefix_forest.strings(x[7:9])).all()
    assert codes.shape == (50, prefix_forest.TREES) and codes.max() < 1 << 5 * prefix_forest.DIGITS
    assert prefix_forest.level_cosines() == sorted(prefix_forest.level_cosines())


# --- 13 ----------------------------------------------------------------------

def plain_drawn(raw, target, percent=5, buckets=10_000):
    def features(text):
        words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        return words, [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]

    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    s, t = (Counter(bucket(f) for x in texts for f in features(x)[1]) for texts in ([x for _, x in raw], target))
    n, m = sum(s.values()), sum(t.values())
    rows = []
    for i, text in raw:
        words, found = features(text)
        weight = sum(math.floor(1000 * math.log((t[bucket(f)] + 1) * (n + buckets) / ((s[bucket(f)] + 1) * (m + buckets))))
                     for f in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, None, len(words)])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for rank, row in enumerate(able[:percent * len(able) // 100], 1):
        row[4] = rank
    return rows


def test_resampling_equals_brute_force(spark, docs):
    rng = random.Random(6)
    words = ["Alpha", "beta", "été", "x9", "don't", "co-op", "日本", "Ünder", "end.", "a_b", "Zeta", "\x7f", "tab\there"]
    raw = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    raw += [(1000, None), (1001, ""), (1002, "?!"), (1003, "one"), (1004, "one two"), (1005, "long text " * 30_000), (7, raw[7][1])]
    raw += [(None, "beta " * 30)]
    target = ["alpha beta x9 été", "日本 日本 end", None]
    frame = docs(raw).repartition(5)
    want = plain_drawn(raw, target)
    assert sum(r[4] is not None for r in want) > 5
    other = spark.createDataFrame([(str(i), x) for i, x in enumerate(target)], "item_id string, text string")
    got = importance_resampling.resample(frame, other, 5).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(key((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"])) for r in got) == sorted(
        key(r[:5]) for r in want)
    assert importance_resampling.resample(docs([]), other, 5).count() == 0
    empty = importance_resampling.resample(frame, other.limit(0), 100).collect()
    assert sum(r["rank"] is not None for r in empty) == sum(r[5] >= 20 for r in want)


def test_resampling_ties_go_to_the_smaller_id(spark):
    rows = [(i, 30, 5, 7, 5) for i in (9, 3, 4, 1)] + [(2, 30, 5, 8, 5), (0, 3, 5, 99, 5)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, score long, weight long")
    got = {r["doc_id"]: r["rank"] for r in importance_resampling.ranked(scored, 60).collect()}
    assert got == {2: 1, 1: 2, 3: 3, 4: None, 9: None, 0: None}
