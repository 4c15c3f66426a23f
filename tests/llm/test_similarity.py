"""Similarity operators (ops 4, 6, 7) against brute force, and the pipeline."""

import random
import re

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from flightlens.llm import embedding_dedup, line_dedup, simhash
from llm_fixtures import docs  # noqa: F401


def roots(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def plain_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(docs, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(150)) for _ in range(12)]
    rows = [(i, base[i % 12] + (f" tail{i}" if i % 3 else "")) for i in range(70)]
    rows += [(90, None), (91, ""), (92, " \n "), (93, "One"), (94, "one"), (95, "Two words"), (96, "É é"), (96, "É é")]
    out = {r["doc_id"]: r for r in simhash.report(docs(rows)).collect()}
    prints = {i: plain_fingerprint(t) for i, t in rows}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    want = roots(prints, links)
    assert {i: r["fingerprint"] for i, r in out.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r["component_id"] for i, r in out.items()} == want
    kept = simhash.one_of_each(docs([*rows, (None, "null id")])).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted({c for c in want.values()})
    assert sum(r["doc_id"] is None for r in kept) == 1
    assert simhash.report(docs([])).count() == 0


def test_one_of_each_judges_rows_that_repeat_an_id_on_their_own(docs):
    rng = random.Random(4)
    copied, alone, other, twice = (" ".join(rng.choice("abcdefghijklmnop") * 3 for _ in range(60)) for _ in range(4))
    rows = [(1, copied), (5, copied), (5, alone), (5, other), (7, twice), (7, twice), (8, alone), (None, copied)]
    kept = simhash.one_of_each(docs(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted(
        [(0, copied), (1, copied), (5, alone), (5, other), (7, twice)])


def test_spanning_links_keep_components():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 10, 300).astype(np.uint64)
    x, y = simhash.spanning_links(a, a, 2, True)
    assert len(x) < 300
    near = [(int(p), int(q)) for p in a for q in a if p < q and (int(p) ^ int(q)).bit_count() <= 2]
    ids = {int(v) for v in a}
    assert roots(ids, list(zip(x.tolist(), y.tolist()))) == roots(ids, near)


def plain_removed(rows):
    lines = []
    for doc, text in rows:
        if doc is not None and text is not None:
            for k, line in enumerate(text.split("\n")):
                words = frozenset(line.encode().lower().split())
                if words:
                    lines.append(((doc, k), words))
    lines.sort(key=lambda x: x[0])
    gone = set()
    for i, (at, words) in enumerate(lines):
        if any(a != at and 5 * len(w & words) >= 4 * len(w | words) for a, w in lines[:i]):
            gone.add(at)
    return gone


def test_line_dedup_equals_brute_force(docs):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(25)]
    seeds = [rng.sample(words, rng.randint(1, 14)) for _ in range(25)]

    def line():
        out = list(rng.choice(seeds))
        if rng.random() < 0.5:
            out[rng.randrange(len(out))] = rng.choice(words)
        rng.shuffle(out)
        return (" " if rng.random() < 0.8 else "\t ").join(w.upper() if rng.random() < 0.1 else w for w in out)

    rows = [(i, "\n".join(line() for _ in range(rng.randint(0, 9)))) for i in range(80)]
    rows += [(90, None), (91, ""), (92, "\n\n \n"), (None, "w1 w2 w3 w4 w5")]
    frame = docs(rows)
    out = {r["doc_id"]: r for r in line_dedup.report(frame).collect()}
    want = plain_removed(rows)
    for doc, text in rows:
        gone = sorted(k for d, k in want if d == doc)
        assert out[doc]["removed_lines"] == ",".join(map(str, gone)), doc
        assert (out[doc]["n_removed"], out[doc]["n_lines"]) == (len(gone), 0 if text is None else text.count("\n") + 1)
    cleaned = line_dedup.remove_lines(frame)
    assert cleaned.columns == frame.columns
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    for doc, text in rows:
        assert texts[doc] == (text if text is None else "\n".join(
            t for k, t in enumerate(text.split("\n")) if (doc, k) not in want))
    assert line_dedup.report(docs([])).count() == 0


@pytest.mark.parametrize("firsts,large,again,salt", [
    (2, 512, 1 << 30, 6), (1, 4, 1 << 30, 500_000), (1, 3, 0, 6), (4, 512, 0, 1)])
def test_line_dedup_with_salted_words(docs, monkeypatch, firsts, large, again, salt):
    """Near lines whose common words go over several salts, batches or large groups meet."""
    monkeypatch.setattr(line_dedup, "ROWS_PER_SALT", salt)
    monkeypatch.setattr(line_dedup, "FIRSTS", firsts)
    monkeypatch.setattr(line_dedup, "LARGE_GROUP", large)
    monkeypatch.setattr(line_dedup, "MEET_AGAIN", again)
    monkeypatch.setattr(line_dedup, "_ROWS", 16)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    seeds = [rng.sample(words, rng.randint(5, 14)) for _ in range(30)]

    def line():
        out = list(rng.choice(seeds))
        out[rng.randrange(len(out))] = rng.choice(words)
        return " ".join(out)

    rows = [(i, "\n".join(line() for _ in range(3))) for i in range(40)]
    got = {(r["doc"], r["line"]) for r in line_dedup.removed_lines(docs(rows)).collect()}
    assert got == plain_removed(rows)


def test_line_whose_only_match_is_matched_itself(docs, monkeypatch):
    """A third line is near a second one only, which goes in the first round: the rounds after must not lose the third."""
    monkeypatch.setattr(line_dedup, "ROWS_PER_SALT", 1)
    monkeypatch.setattr(line_dedup, "MEET_AGAIN", 0)
    rows = []
    for k in range(40):
        words = [f"f{k}w{i}" for i in range(20)]
        rows += [(3 * k, " ".join(words)), (3 * k + 1, " ".join(words[:16])), (3 * k + 2, " ".join(words[:13]))]
    want = plain_removed(rows)
    assert len(want) == 80
    assert {(r["doc"], r["line"]) for r in line_dedup.removed_lines(docs(rows)).collect()} == want


def test_embedding_recall_and_links(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 64)  # several tiles per bucket
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 24))
    vectors = [centres[i % 30] + rng.normal(size=24) * rng.choice([0.0, 0.05, 0.2, 1.0]) for i in range(600)]
    rows = [(i, [float(x) for x in np.float32(v)], i % 2) for i, v in enumerate(vectors)]
    dirty = [(1000, None, 0), (1001, [0.0] * 24, 0), (1002, [float("nan")] * 24, 0), (1003, rows[0][1], None),
             (1004, [None] + rows[0][1][1:], 0), (1005, rows[0][1][:5], 0), (1006, [], 0), (1007, [float("inf")] * 24, 1)]
    frame = spark.createDataFrame(rows + dirty, "vec_id long, embedding array<float>, label int")
    out = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(frame).collect()}
    assert len(out) == 608
    unit = np.array([v for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & ((np.arange(600)[:, None] - np.arange(600)) % 2 == 0)
    np.fill_diagonal(near, False)
    found = np.array([out[i]["n_links"] for i in range(600)])
    assert (found == near.sum(1)).all()
    want = roots(range(600), [(int(a), int(b)) for a, b in np.argwhere(near) if a < b])
    assert {i: out[i]["component_id"] for i in range(600)} == want
    for i, *_ in dirty:
        assert (out[i]["n_links"], out[i]["component_id"], out[i]["kept"]) == (0, i, True)
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_embedding_rows_with_null_repeated_and_extreme_values(spark):
    """Every row against brute force: rows are vectors of their own, whatever their id; sizes of components do not matter."""
    rng = np.random.default_rng(8)
    a, b, c = (rng.normal(size=16) for _ in range(3))

    def near(v, e=0.05):
        return [float(x) for x in v + rng.normal(size=16) * e]

    rows = [(1, near(a, 0), 0), (1, near(b, 0), 0), (2, near(a), 0), (3, near(b), 0), (4, near(b), 0), (1, near(a, 0), 0),
            (7, near(c), 0), (7, near(c), 0), (20, [x * 1e200 for x in near(a)], 0), (21, [x * 1e-200 for x in near(b)], 0),
            (None, near(a, 0), 0), (None, near(c), 1), (30, near(c), 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    unit = np.array([np.array(v) / np.abs(v).max() for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = [[i != j and rows[i][0] is not None and rows[j][0] is not None and rows[i][2] == rows[j][2]
               and float(unit[i] @ unit[j]) >= 0.93 for j in range(len(rows))] for i in range(len(rows))]
    tops = roots(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if linked[i][j]])
    lowest = {t: min(rows[i][0] for i in tops if tops[i] == t and rows[i][0] is not None)
              for t in set(tops.values()) if rows[t][0] is not None}
    want = sorted(((r[0] or 0), sum(linked[i]), lowest.get(tops[i], 0), r[0] is None or r[0] == lowest[tops[i]])
                  for i, r in enumerate(rows))
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"])
                 for r in embedding_dedup.near_duplicates(frame).collect())
    assert got == want


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 32))
    y = embedding_dedup.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    assert np.allclose(embedding_dedup.hadamard(y), x)


def test_pipeline_stages(spark):
    """Each stage against its own rule on its own input; columns stay, good documents stay."""
    sf_dir = "/root/testdata/sf0.001"
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumnsRenamed({"n_chars": "kept"})
    frames = [frame]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(spark.createDataFrame(stage(spark, frames[-1], sf_dir).toPandas()))
    for after in frames[1:-1]:
        assert after.columns == frame.columns
    known, judged, lines, single, packed = (f.toPandas() for f in frames[1:])
    assert len(known) >= 0.95 * frame.count()
    gone = plain_removed(list(zip(judged.doc_id.tolist(), judged.text)))
    want = {d: "\n".join(t for k, t in enumerate(x.split("\n")) if (d, k) not in gone) for d, x in zip(judged.doc_id, judged.text)}
    assert dict(zip(lines.doc_id, lines.text)) == want
    prints = {d: plain_fingerprint(t) for d, t in zip(lines.doc_id, lines.text)}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    assert set(single.doc_id) == set(roots(prints, links).values())
    assert set(packed.doc_id) == set(single.doc_id) and packed.groupby("sequence_id").length.sum().max() <= 4096
