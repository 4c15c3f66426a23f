"""Quality rules by hashed n-gram log-likelihood ratio, in DataFrame functions only.

Words and pairs of neighbouring words are hashed into ``BUCKETS`` buckets
each. Two multinomials are estimated over the buckets: the raw corpus (every
document) and the trusted target (documents labelled good). A document's score
is the mean over its n-grams of ln(target share) - ln(raw share). Weights are rounded to millionths and summed as
integers, so every document's verdict is the same whatever the order.

The threshold is calibrated: the target is fitted on one half of the trusted
documents, and ``MARGIN`` below the ``QUANTILE`` of the other half's scores a
document is rejected. Unlabelled good documents score like that other half,
whatever the size of the corpus or of the labelled sample.

Base rules come first: too few words, or too many words in repeated three-word
windows, fail a document.

The raw counts cover every word of every document, and every trusted document
either fits the target or calibrates the threshold; ids with any bad or toxic
label are not trusted. Three-word windows are screened by hashes and compared
word by word where hashes repeat.

Defined results: a null or empty text has no words and fails the base rules;
without trusted documents to fit and to calibrate only base rules reject;
labels with a null id or quality are ignored; repeated rows each give their
row; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlens.llm.common import stored
from flightlens.operators.dims import broadcast_if_small

BUCKETS = 16384
#: Trusted documents up to which ``ORACLE_SQL`` takes all of them, as the operator does at any size; above, it draws.
TRUSTED_DOCUMENTS = 20_000
#: Quantile of the calibrating scores, and millionths of a nat per n-gram that a document may fall below it.
QUANTILE = 0.001
MARGIN = 20_000
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
_SCALE = 1_000_000
#: Multipliers of the pair hash and of the draw.
_PAIR, _DRAW = 1_000_003, 2_654_435_761

# Fixed values of the contract: white space that separates words, and symbols.
_SPACES = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(_SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def _pair_bucket(first: str, second: str) -> str:
    return f"({first} * {_PAIR} + {second}) % {BUCKETS} + {BUCKETS}"


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Ids of documents whose labels are all good and never toxic, one row each.

    ``id`` and ``fits``: true for the half that the target is fitted on, false for the half that calibrates.
    """
    good = (labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
            .groupBy(F.col(id_col).alias("id"))
            .agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
            .where("q = 1 and t = 0"))
    draw = F.pmod(F.col("id").cast("long") * _DRAW, F.lit(1 << 32))
    fits = F.floor(draw / (1 << 16)) % 2 == 0
    return good.select("id", fits.alias("fits"))


def weights(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[int]:
    """ln(target share) - ln(raw share) of each bucket in millionths; ``2 * BUCKETS`` numbers.

    One pass over the documents; the trusted ids are broadcast where they are
    small (measured), the shuffle moves one partial count per bucket and task.
    """
    words = docs.select(F.col(id_col).alias("id"), _words(F.col(text_col)).alias("w"))
    good, _ = broadcast_if_small(trusted_ids(labels).where("fits").select("id", F.lit(1).alias("good")), persist=False)
    marked = words.join(good, "id", "left")
    # Each word with its successor as a row: what follows is generated code, without an array per document.
    pairs = marked.select("good", F.explode(F.expr("arrays_zip(w, slice(w, 2, greatest(size(w) - 1, 0)))")).alias("p"))
    coded = pairs.select("good", F.crc32(F.col("p")["w"].cast("binary")).alias("a"),
                         F.crc32(F.col("p")["1"].cast("binary")).alias("b"))
    buckets = F.array(F.col("a") % BUCKETS, F.expr(_pair_bucket("a", "b")))
    marked = coded.select("good", F.explode(buckets).alias("bucket")).where("bucket is not null")
    counts = (marked.groupBy("bucket")
              .agg(F.count(F.lit(1)).alias("raw"), F.count("good").alias("target")))
    buckets = docs.sparkSession.range(2 * BUCKETS).withColumnRenamed("id", "bucket")
    filled = buckets.join(counts, "bucket", "left").select(
        "bucket", (F.coalesce("raw", F.lit(0)) + 1).alias("raw"), (F.coalesce("target", F.lit(0)) + 1).alias("target"))
    kind = F.col("bucket") >= BUCKETS
    sums = filled.groupBy(kind.alias("kind")).agg(F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target"))
    ratio = (F.log(F.col("target") / F.col("all_target")) - F.log(F.col("raw") / F.col("all_raw"))) * _SCALE
    table = (filled.withColumn("kind", kind).join(F.broadcast(sums), "kind")
             .select("bucket", F.round(ratio).cast("long").alias("weight")).collect())
    return [w for _, w in sorted((r["bucket"], r["weight"]) for r in table)]


def threshold(docs: DataFrame, labels: DataFrame, weight: list[int], id_col: str = "doc_id",
              text_col: str = "text") -> int | None:
    """Lowest accepted score in millionths; None where nothing calibrates it. Scores the documents that calibrate."""
    ids, _ = broadcast_if_small(trusted_ids(labels).where("not fits").select("id"), persist=False)
    held = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(ids, "id", "left_semi")
    return _least(judge(held, weight, None, ["id"]))


def _least(scored: DataFrame) -> int | None:
    """``MARGIN`` below the ``QUANTILE`` of the scores (rounded down) of judged rows that pass the base rules."""
    score = F.floor(F.col("total") / F.greatest(F.col("n_grams"), F.lit(1)))
    counts = stored(scored.where("not base_failed").groupBy(score.alias("score")).agg(F.count(F.lit(1)).alias("n"))
                    .withColumn("range", F.floor(F.col("score") / 1000)), "trusted-scores")
    # A score is a mean of logarithms of shares, so there are at most some ten thousand ranges of a thousand scores.
    ranges = sorted(map(tuple, counts.groupBy("range").agg(F.sum("n")).collect()))
    left = int(QUANTILE * sum(n for _, n in ranges))
    for at, n in ranges:
        if left < n:
            for score, m in sorted(map(tuple, counts.where(F.col("range") == at).select("score", "n").collect())):
                if left < m:
                    return score - MARGIN
                left -= m
        left -= n
    return None


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
        text_col: str = "text") -> tuple[list[int], int | None]:
    """Weights and threshold for ``judge``."""
    weight = weights(docs, labels, id_col, text_col)
    return weight, threshold(docs, labels, weight, id_col, text_col)


def measures(text: Column, prefix: str = "") -> list[Column]:
    """word_chars, n_symbols and n_dup_lines as columns."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, _SPACES, "") != "")
    return [F.coalesce(F.length(F.translate(text, _SPACES, "")), F.lit(0)).cast("long").alias(f"{prefix}word_chars"),
            F.coalesce(F.length(text) - F.length(F.translate(text, _SYMBOLS, "")), F.lit(0)).cast("long")
            .alias(f"{prefix}n_symbols"),
            F.coalesce(F.size(lines) - F.size(F.array_distinct(lines)), F.lit(0)).cast("long")
            .alias(f"{prefix}n_dup_lines")]


def judge(docs: DataFrame, weight: list[int], least: int | None, keep: list[str],
          text_col: str = "text") -> DataFrame:
    """The ``keep`` columns with n_words, the measures, base_failed, kept, and the score as total / n_grams.

    ``least`` is the lowest accepted score in millionths. Row by row, without a shuffle.
    """
    inner = {f"k{i}__": c for i, c in enumerate(keep)}
    text = F.coalesce(F.col(text_col), F.lit(""))
    step = docs.select(*(F.col(c).alias(a) for a, c in inner.items()), text.alias("t"), _words(text).alias("w"))
    step = step.select(*inner, "w", *measures(F.col("t")))
    step = step.withColumns({"c": F.transform("w", lambda w: F.crc32(w.cast("binary"))),
                             "n_words": F.size("w").cast("long")})
    step = step.withColumn("x", F.expr(
        "transform(slice(c, 1, greatest(size(c) - 2, 0)), (a, i) -> xxhash64(a, get(c, i + 1), get(c, i + 2)))"))
    # Different hashes mean different windows. Where hashes repeat, the windows themselves are compared: equal
    # ones stand side by side in sorted order, and their places cover three words each.
    step = step.withColumn("s", F.expr(
        "case when size(array_distinct(x)) < size(x) then array_sort(transform(x, (h, i) -> "
        "struct(h, get(w, i) as a, get(w, i + 1) as b, get(w, i + 2) as c, i))) end"))
    step = step.withColumn("p", F.expr(
        "array_sort(transform(filter(s, (e, i) -> "
        "coalesce(e.h = get(s, i - 1).h and e.a = get(s, i - 1).a and e.b = get(s, i - 1).b and e.c = get(s, i - 1).c, false)"
        " or coalesce(e.h = get(s, i + 1).h and e.a = get(s, i + 1).a and e.b = get(s, i + 1).b and e.c = get(s, i + 1).c, false)"
        "), e -> e.i))"))
    repeated = F.expr("aggregate(p, struct(0L as covered, -3 as last), "
                      "(acc, at) -> struct(acc.covered + least(3, at - acc.last) as covered, at as last), "
                      "acc -> acc.covered)")
    table = F.split(F.lit(",".join(map(str, weight))), ",").cast("array<bigint>")  # folded to a constant
    none = F.struct(F.lit(0).cast("long").alias("total"), F.lit(None).cast("long").alias("last"))

    def add(acc, crc):
        pair = (acc["last"] * _PAIR + crc) % BUCKETS + BUCKETS
        gain = F.get(table, (crc % BUCKETS).cast("int")) + F.coalesce(F.get(table, pair.cast("int")), F.lit(0))
        return F.struct((acc["total"] + gain).alias("total"), crc.alias("last"))

    total = F.aggregate("c", none, add, lambda acc: acc["total"])
    step = step.select(*inner, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       F.coalesce(repeated, F.lit(0).cast("long")).alias("n_repeat_words"),
                       total.alias("total"), F.greatest(2 * F.col("n_words") - 1, F.lit(0)).alias("n_grams"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEATED_PERCENT) * F.col("n_words"))
    # The row number (never negative) keeps the optimizer from moving a filter on either verdict below the
    # projections, which would copy the array functions into it many times over.
    step = step.withColumn("base_failed", failed & (F.monotonically_increasing_id() >= 0))
    # In whole millionths on both sides: no rounding decides a verdict.
    high = F.lit(True) if least is None else F.col("total") >= F.lit(least).cast("long") * F.col("n_grams")
    verdict = ~F.col("base_failed") & high & (F.monotonically_increasing_id() >= 0)
    return step.select(*(F.col(a).alias(c) for a, c in inner.items()), "n_words", "word_chars", "n_symbols",
                       "n_dup_lines", "n_repeat_words", "base_failed", verdict.alias("kept"), "total", "n_grams")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id with the base measures, base_failed and kept.

    Every document is scored once: the threshold is taken from the stored scores of those that calibrate it.
    """
    judged = stored(judge(docs, weights(docs, labels), None, ["doc_id"]), "quality-judged")
    ids, _ = broadcast_if_small(trusted_ids(labels).where("not fits").select(F.col("id").alias("doc_id")), persist=False)
    least = _least(judged.join(ids, "doc_id", "left_semi"))
    if least is not None:
        high = F.col("total") >= F.lit(least).cast("long") * F.col("n_grams")
        judged = judged.withColumn("kept", F.col("kept") & high)
    return judged.drop("total", "n_grams")


#: The same rows in DuckDB: crc32 byte by byte from its definition, windows as word lists.
ORACLE_SQL = f"""
WITH RECURSIVE bits AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
),
steps AS (SELECT list(c ORDER BY i) AS tbl FROM bits WHERE k = 8),
docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
places AS (SELECT rid, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs),
vocabulary AS (SELECT DISTINCT word FROM places),
octets AS (
  SELECT word, hex(encode(word)) AS digits, octet_length(encode(word)) AS n FROM vocabulary
),
crcs AS (
  SELECT word, xor(list_reduce(list_concat([4294967295::BIGINT],
           list_transform(range(0, n), lambda j: ('0x' || substr(digits, 2 * j + 1, 2))::BIGINT)),
           lambda a, b: xor(a >> 8, tbl[(xor(a, b) & 255) + 1])), 4294967295) AS crc
  FROM octets, steps
),
coded AS (SELECT rid, doc_id, i, crc FROM places JOIN crcs USING (word)),
grams AS (
  SELECT rid, doc_id, crc % {BUCKETS} AS bucket FROM coded
  UNION ALL
  SELECT a.rid, a.doc_id, (a.crc * {_PAIR} + b.crc) % {BUCKETS} + {BUCKETS}
  FROM coded a JOIN coded b ON a.rid = b.rid AND b.i = a.i + 1
),
good AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL
  GROUP BY doc_id HAVING min(quality) = 1 AND max(coalesce(toxic, 0)) = 0
),
drawn AS (
  SELECT doc_id, ((doc_id::HUGEINT * {_DRAW}) % 4294967296 // 65536) % 2 = 0 AS fits FROM good
  WHERE (doc_id::HUGEINT * {_DRAW}) % 4294967296
        < floor(least(1.0, {TRUSTED_DOCUMENTS}.0 / (SELECT greatest(count(*), 1) FROM good)) * 4294967296)
),
trusted AS (SELECT doc_id FROM drawn WHERE fits),
counts AS (
  SELECT bucket, count(*) AS raw, count(t.doc_id) AS target
  FROM grams g LEFT JOIN trusted t USING (doc_id) GROUP BY bucket
),
filled AS (
  SELECT b.bucket, b.bucket >= {BUCKETS} AS kind, coalesce(raw, 0) + 1 AS raw, coalesce(target, 0) + 1 AS target
  FROM range({2 * BUCKETS}) b(bucket) LEFT JOIN counts USING (bucket)
),
sums AS (SELECT kind, sum(raw) AS all_raw, sum(target) AS all_target FROM filled GROUP BY kind),
weights AS (
  SELECT bucket, round((ln(target::DOUBLE / all_target::DOUBLE) - ln(raw::DOUBLE / all_raw::DOUBLE))
                       * {_SCALE})::BIGINT AS weight
  FROM filled JOIN sums USING (kind)
),
scores AS (SELECT rid, sum(weight) AS total, count(*) AS n_grams FROM grams JOIN weights USING (bucket) GROUP BY rid),
windows AS (
  SELECT a.rid, a.i, a.word AS x, b.word AS y, c.word AS z FROM places a
  JOIN places b ON a.rid = b.rid AND b.i = a.i + 1 JOIN places c ON a.rid = c.rid AND c.i = a.i + 2
),
again AS (SELECT rid, x, y, z FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT rid, count(DISTINCT i + d.k) AS n
  FROM windows JOIN again USING (rid, x, y, z), (VALUES (0), (1), (2)) d(k) GROUP BY rid
),
lines AS (
  SELECT rid, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l FROM docs
),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         coalesce(total, 0) AS total, coalesce(n_grams, 0) AS n_grams
  FROM docs JOIN lines USING (rid) LEFT JOIN covered c USING (rid) LEFT JOIN scores USING (rid)
),
based AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed
  FROM measured
),
held AS (
  SELECT floor(total::DOUBLE / n_grams::DOUBLE)::BIGINT AS score,
         row_number() OVER (ORDER BY floor(total::DOUBLE / n_grams::DOUBLE)) - 1 AS place, count(*) OVER () AS n
  FROM based WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM drawn WHERE NOT fits)
),
limits AS (SELECT max(score) - {MARGIN} AS least FROM held WHERE place = floor({QUANTILE} * n))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(total >= least * n_grams, true) AS kept
FROM based, limits
"""
