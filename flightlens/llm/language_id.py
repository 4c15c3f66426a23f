"""Language identification by compression with per-language zstandard dictionaries.

For each language a raw-content dictionary is made of sample texts. A text,
lower-cased and reduced to its letters with single blanks between words, is
compressed whole once per dictionary; the language whose dictionary gives the
fewest bytes is predicted. The margin is what the next best language takes
more, relative to the best size (or ``MARGIN_BYTES`` if that is less, since a
long text soon outweighs any dictionary). A text with a narrow margin is
rejected; its prediction stands.

The dictionaries are the only thing fitted, on a bounded sample of labelled
rows: for each language the ``SAMPLE_TEXTS`` rows with the smallest hash of
their id, a window of ``SAMPLE_CHARS`` characters each, at a place that a hash
draws from the whole text (shorter texts whole), as many as fit ``DICTIONARY_BYTES``. Prediction reads every whole text and nothing but the text.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and rejected; ties go to the alphabetically first language with score 0; with
no labelled row at all everything is ``und``; repeated rows each give their
row; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlens.llm.common import map_arrow, slices

UNKNOWN = "und"
SAMPLE_TEXTS = 500
SAMPLE_CHARS = 500
DICTIONARY_BYTES = 256 * 1024
LEVEL = 7
MARGIN_BYTES = 4096
#: Margins below this are narrow.
MIN_MARGIN = 0.002

_LETTER = regex.compile(r"\p{L}")
#: Everything in ASCII that is not a letter becomes a blank; other bytes stay.
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def normal(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()) + b" "


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """True for the rows kept from learning: crc32 of the id as text divisible by ``folds``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Dictionary bytes per language from the labelled rows of ``df``.

    Rows are thinned by a hash of their id to a few times the sample before any
    ordering, so no language's rows meet in one task.
    """
    labelled = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("draw"), F.col(text_col).alias("text"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}
    share = F.lit(0.0)
    for lang, n in sizes.items():  # as many terms as languages
        share = F.when(F.col("lang") == lang, min(1.0, 3 * SAMPLE_TEXTS / n)).otherwise(share)
    drawn = labelled.where(F.pmod("draw", F.lit(1 << 20)) < share * (1 << 20))
    order = Window.partitionBy("lang").orderBy("draw", "text")
    room = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    begin = F.pmod(F.xxhash64("draw", F.lit(SAMPLE_CHARS)), room.cast("long")).cast("int") + 1
    window = F.substring(F.col("text"), begin, F.lit(SAMPLE_CHARS))
    sample = (drawn.select("lang", "draw", window.alias("text"))
              .withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE_TEXTS))
    texts: dict[str, list] = {}
    for row in sample.collect():
        texts.setdefault(row["lang"], []).append((row["place"], row["text"]))
    out = {}
    for lang, rows in texts.items():
        parts, size = [], 0
        for _, text in sorted(rows):
            part = normal(text)
            if size + len(part) <= DICTIONARY_BYTES:
                parts.append(part)
                size += len(part)
        out[lang] = b"".join(parts)
    return out


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = sorted(dictionaries)
        self.encoders = []
        for lang in self.languages:
            data = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            self.encoders.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, margin cut to 0..1, rejected)."""
        if not self.encoders or not text or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        plain = normal(text)
        sizes = sorted((len(encoder.compress(plain)), lang) for encoder, lang in zip(self.encoders, self.languages))
        best, lang = sizes[0]
        if len(sizes) == 1:
            return lang, 1.0, False
        margin = (sizes[1][0] - best) / min(best, MARGIN_BYTES)
        return lang, min(1.0, margin), margin < MIN_MARGIN


def classify(df: DataFrame, dictionaries: dict[str, bytes], keep: list[str], text_col: str = "text",
             names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """The ``keep`` columns of every row with the predicted language, its score and whether it is rejected."""
    inner = [f"k{i}" for i in range(len(keep))]
    schema = ", ".join([*(f"{a} {df.schema[c].dataType.simpleString()}" for a, c in zip(inner, keep)),
                        "lang string, score double, rejected boolean"])

    def run(batches):
        classifier = Classifier(dictionaries)
        for batch in slices(batches, 500):
            rows = [classifier.predict(t) for t in batch.column(len(inner)).to_pylist()]
            lang, score, rejected = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(inner)], pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())], [*inner, "lang", "score", "rejected"])

    chosen = df.select(*(F.col(c).alias(a) for a, c in zip(inner, keep)), F.col(text_col).alias("text"))
    return map_arrow(chosen, run, schema).toDF(*keep, *names)


def report(df: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; learned from the rows that are not held out."""
    rows = df.withColumn("held_out", held_out())
    return classify(rows, learn(rows.where(~F.col("held_out"))), ["doc_id", "held_out"])
