"""Masked pseudo-likelihood scores from a bidirectional window network trained in numpy.

Every token is predicted from the ``WINDOW`` tokens on either side of it, never
from itself. The network adds position-wise projections of the neighbours'
embeddings, applies tanh, and predicts the token's id in two steps, its class and
then its place in the class (so a prediction costs the square root of the ids).
The most frequent words have an id each. All others share ``RARE`` ids by a hash,
and a third step predicts the word among those of its id by its share of their
occurrences. So the probabilities of all words of the corpus add up to one, and
a document's score, the sum over its tokens of the conditional log-probabilities,
is one of words; ``mean_logprob`` divides by the number of tokens.

Tokens are words (A-Z lower-cased). What is gathered grows with the corpus: the
count of every word of every document is a table (``word_counts``), which meets
the rare words of the documents in a join by the 64-bit hash of the word; a word
outside the vocabulary holds less than one ``VOCABULARY``-th of the tokens, so no
key of the join is hot. (Words of equal hash would count as one: among 10**9
words some pair does with probability 0.03.)

Training passes once over every document: they are dealt into
``ROUNDS`` rounds by a hash of their text; in a round every task runs
mini-batch descent over its documents from the same start, and the round ends
with the average of the tasks' weights, weighted by tokens. The weights of all
tasks are summed by Spark into at most ``SUMS`` rows first; only these, the
vocabulary (``VOCABULARY`` words) and the totals of the shared ids reach the driver.

Defined results: null and empty texts have no token, score 0 and a null mean;
a single token is predicted from padding alone; repeated rows each give their
row; null ids are kept; an empty table gives no rows; further columns are
ignored. Seeded throughout; sums of floats follow the order of documents in a
task, so repeated runs agree to rounding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlens.llm.common import map_arrow, slices, stored

VOCABULARY = 960
RARE = 64
CLASSES = 32  # VOCABULARY + RARE ids in equal classes
WINDOW = 2
WIDTH = 16
ROUNDS = 3
SUMS = 32
RATE = 2.0
BATCH = 4096
#: Tokens scored together: their logits fit a core's cache.
_SCORED = 16_384
#: Weights stay within this, so that no logit overflows float32.
_LIMIT = 4.0
SEED = 7
#: Seed of the word hash: the one Spark's xxhash64 has.
_HASH_SEED = 42
#: Words a task counts together before it hands the counts on.
_COUNTED_WORDS = 2_000_000
#: Distinct words a task knows by heart before it starts anew.
_HELD_WORDS = 300_000
_IDS = VOCABULARY + RARE
_PER_CLASS = _IDS // CLASSES
_PAD = _IDS
_ONES = np.ones(CLASSES, np.float32)
assert CLASSES == _PER_CLASS


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts (A-Z lower-cased), one text after the other, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, sizes = lists.flatten(), lists.value_lengths().to_numpy()
    filled = pc.greater(pc.binary_length(flat), 0)  # white space at an end of a text leaves an empty one
    ends = np.concatenate(([0], np.cumsum(filled.to_numpy(zero_copy_only=False))))[np.cumsum(sizes)]
    return flat.filter(filled), np.diff(ends, prepend=0)


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """w, n: every word of the whole corpus with its occurrences (stored)."""
    def count(batches):
        held: list[pa.Array] = []

        def part():
            found = pa.chunked_array(held, pa.string()).value_counts()
            held.clear()
            return pa.RecordBatch.from_arrays([found.field(0), found.field(1)], ["w", "n"])

        for batch in slices(batches, 400):
            held.append(_split(batch.column(0))[0])
            if sum(map(len, held)) > _COUNTED_WORDS:
                yield part()
        yield part()

    texts = df.select(F.col(text_col).alias("text")).where("text is not null")
    parts = map_arrow(texts, count, "w string, n long")
    return stored(parts.groupBy("w").agg(F.sum("n").alias("n")), "lm-words")


def vocabulary(counts: DataFrame) -> list[str]:
    """The most frequent words; ties in order of the word."""
    return [r["w"] for r in counts.orderBy(F.desc("n"), "w").limit(VOCABULARY).collect()]


def rare_shares(counts: DataFrame, words: list[str]) -> DataFrame:
    """h, share: for the words without an id of their own the log of their part of the shared id's occurrences."""
    fixed = counts.sparkSession.createDataFrame([(w,) for w in words], "w string")
    rare = counts.join(F.broadcast(fixed), "w", "left_anti").select(F.xxhash64("w").alias("h"), "n")
    shared = F.col("h").bitwiseAND(F.lit(RARE - 1))
    totals = {r["id"]: r["n"] for r in rare.groupBy(shared.alias("id")).agg(F.sum("n").alias("n")).collect()}
    total = F.array(*(F.lit(float(totals.get(i, 1))) for i in range(RARE)))
    return (rare.groupBy("h").agg(F.sum("n").alias("n"))
            .select("h", (F.log("n") - F.log(F.get(total, shared.cast("int")))).alias("share")))


def _listed(words: pa.Array) -> list[bytes]:
    """An array of words as bytes; they hold no blank, so one text of all is cut (an object for each value costs far more)."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")
    return joined.cast(pa.binary())[0].as_py().split()


class Words:
    """Word -> place in ``ids`` and ``hashes``; kept for the words of a task up to a bound."""

    def __init__(self, vocabulary: list[str]):
        self.vocabulary = [w.encode() for w in vocabulary]
        self._restart()

    def _restart(self) -> None:
        self.known = {w: i for i, w in enumerate(self.vocabulary)}
        self.ids = np.arange(2 * _HELD_WORDS, dtype=np.int64)
        self.hashes = np.zeros(2 * _HELD_WORDS, np.int64)

    def places(self, text: str | None) -> np.ndarray:
        return self.places_of(pa.array([text], pa.string()))[0]

    def places_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Place of each word of the texts, one text after the other, and how many words each text has.

        A place stays what it is until ``make_room``.
        """
        flat, sizes = _split(texts)
        coded = flat.dictionary_encode()
        words = _listed(coded.dictionary)
        known = self.known
        new = [w for w in words if w not in known]
        if new:
            begin = len(known)
            end = begin + len(new)
            if end > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(end, np.int64)])
                self.hashes = np.concatenate([self.hashes, np.zeros(end, np.int64)])
            known.update(zip(new, range(begin, end)))
            hashes = np.array([xxhash.xxh64_intdigest(w, _HASH_SEED) for w in new], np.uint64).view(np.int64)
            self.hashes[begin:end] = hashes
            self.ids[begin:end] = VOCABULARY + (hashes & (RARE - 1))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()], sizes

    def make_room(self) -> None:
        if len(self.known) > _HELD_WORDS:
            self._restart()


class Network:
    """Weights and the mathematics of the window network."""

    NAMES = ("embed", "mix", "bias", "cls", "cls_bias", "member", "member_bias")

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        if weights is None:
            rng = np.random.default_rng(SEED)
            weights = {
                "embed": rng.normal(0, 0.3, (_IDS + 1, WIDTH)),
                "mix": rng.normal(0, 0.3, (2 * WINDOW * WIDTH, WIDTH)),
                "bias": np.zeros(WIDTH),
                "cls": rng.normal(0, 0.1, (WIDTH, CLASSES)),
                "cls_bias": np.zeros(CLASSES),
                "member": rng.normal(0, 0.1, (CLASSES, WIDTH, _PER_CLASS)),
                "member_bias": np.zeros((CLASSES, _PER_CLASS)),
            }
        self.w = {k: np.asarray(v, np.float32) for k, v in weights.items()}

    def packed(self) -> bytes:
        return b"".join(self.w[k].astype("<f4").tobytes() for k in self.NAMES)

    @classmethod
    def unpacked(cls, raw: bytes) -> Network:
        out, at = cls(), 0
        for k in cls.NAMES:
            shape = out.w[k].shape
            size = int(np.prod(shape))
            out.w[k] = np.frombuffer(raw, "<f4", size, at).reshape(shape).astype(np.float32)
            at += 4 * size
        return out

    def _hidden(self, context: np.ndarray) -> np.ndarray:
        mix = self.w["mix"].reshape(2 * WINDOW, WIDTH, WIDTH)
        # Each position's projection is computed once for every id, then looked up.
        total = self.w["bias"] + (self.w["embed"] @ mix[0]).take(context[:, 0], 0)
        for k in range(1, 2 * WINDOW):
            total += (self.w["embed"] @ mix[k]).take(context[:, k], 0)
        return np.tanh(total, out=total)

    def logprobs(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log P(target | context) of each row."""
        w = self.w
        order, bounds = _by_class(target)
        context, target = context[order], target[order]
        h = self._hidden(context)
        z = h @ w["cls"] + w["cls_bias"]
        found = z[np.arange(len(target)), target % CLASSES] - np.log(np.exp(z) @ _ONES)
        place = target // CLASSES
        for c, at, end in bounds:
            z = h[at:end] @ w["member"][c] + w["member_bias"][c]
            found[at:end] += z[np.arange(end - at), place[at:end]] - np.log(np.exp(z) @ _ONES)
        out = np.empty(len(target))
        out[order] = found
        return out

    def learn(self, context: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One step of gradient ascent on the mean log-probability of a mini-batch."""
        w, n = self.w, len(target)
        order, bounds = _by_class(target)
        context, target = context[order], target[order]
        h = self._hidden(context)
        place = target // CLASSES
        p = np.exp(h @ w["cls"] + w["cls_bias"])
        p /= (p @ _ONES)[:, None]
        p[np.arange(n), target % CLASSES] -= 1
        back = p @ w["cls"].T
        grad_cls, grad_cls_bias = h.T @ p, p.sum(0)
        for c, at, end in bounds:
            q = np.exp(h[at:end] @ w["member"][c] + w["member_bias"][c])
            q /= (q @ _ONES)[:, None]
            q[np.arange(end - at), place[at:end]] -= 1
            back[at:end] += q @ w["member"][c].T
            step = rate / max(end - at, 32)
            w["member"][c] -= step * (h[at:end].T @ q)
            w["member_bias"][c] -= step * q.sum(0)
        back *= 1 - h * h
        # What flows back to each id at each position, then through that position's projection.
        ids = _IDS + 1
        flat = (context + np.arange(2 * WINDOW) * ids).T.ravel()
        into = np.empty((2 * WINDOW * ids, WIDTH), np.float32)
        for d, column in enumerate(np.ascontiguousarray(back.T, np.float64)):
            into[:, d] = np.bincount(flat, np.concatenate((column,) * (2 * WINDOW)), 2 * WINDOW * ids)
        into = into.reshape(2 * WINDOW, ids, WIDTH)
        seen = np.bincount(flat, minlength=2 * WINDOW * ids).reshape(2 * WINDOW, ids).sum(0)
        mix = w["mix"].reshape(2 * WINDOW, WIDTH, WIDTH)
        grad_embed = (into @ mix.transpose(0, 2, 1)).sum(0)
        grad_mix = (w["embed"].T @ into).reshape(w["mix"].shape)
        w["mix"] -= rate / n * grad_mix
        w["bias"] -= rate / n * back.sum(0)
        w["cls"] -= rate / n * grad_cls
        w["cls_bias"] -= rate / n * grad_cls_bias
        w["embed"] -= (rate * grad_embed / np.maximum(seen, 32)[:, None]).astype(np.float32)
        for name in ("cls", "cls_bias", "member", "member_bias"):
            np.clip(w[name], -_LIMIT, _LIMIT, out=w[name])


def _by_class(target: np.ndarray):
    """Order of the rows by their target's class, and (class, first, end) of each class that has rows."""
    kind = (target % CLASSES).astype(np.uint8)
    order = np.argsort(kind, kind="stable")
    ends = np.cumsum(np.bincount(kind, minlength=CLASSES)).tolist()
    return order, [(c, at, end) for c, (at, end) in enumerate(zip([0, *ends], ends)) if at < end]


def windows(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(context ids, target id) of every token of the documents; padding at their ends."""
    gap = np.full(WINDOW, _PAD, np.int64)
    flat = np.concatenate([gap, *(part for d in documents for part in (d, gap))])
    at = np.flatnonzero(flat != _PAD)
    return np.stack([flat[at + k] for k in (*range(-WINDOW, 0), *range(1, WINDOW + 1))], 1), flat[at]


def _summed(batches):
    """Rows of (tokens, weights times tokens) added up to one."""
    total, mean = 0, None
    for batch in slices(batches, 16):
        for n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(raw, "<f4").astype(np.float64) * n
            mean = part if mean is None else mean + part
            total += n
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array([total], pa.int64()), pa.array([(mean / total).astype("<f4").tobytes()], pa.binary())],
            ["tokens", "weights"])


def train(df: DataFrame, words: list[str], text_col: str = "text") -> bytes:
    """Weights after one pass over all documents in ``ROUNDS`` rounds of descent and averaging."""
    sc = df.sparkSession.sparkContext
    texts = df.select(F.col(text_col).alias("text")).where("text is not null")
    weights = Network().packed()
    for turn in range(ROUNDS):
        start, rate = sc.broadcast(weights), RATE / (1 + turn)

        def run(batches, start=start, rate=rate):
            net, vocabulary, seen = Network.unpacked(start.value), Words(words), 0
            for batch in slices(batches, 400):
                places, sizes = vocabulary.places_of(batch.column(0))
                context, target = windows(np.split(vocabulary.ids[places], np.cumsum(sizes)[:-1]))
                vocabulary.make_room()
                order = np.random.default_rng([SEED, seen]).permutation(len(target))
                for at in range(0, len(order), BATCH):
                    part = order[at:at + BATCH]
                    net.learn(context[part], target[part], rate)
                seen += len(target)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seen], pa.int64()), pa.array([net.packed()], pa.binary())], ["tokens", "weights"])

        schema = "tokens long, weights binary"
        dealt = texts.where(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == turn)
        made = stored(map_arrow(dealt, run, schema), "lm-weights")
        rows = map_arrow(made.repartition(SUMS), _summed, schema).collect()
        total = sum(r["tokens"] for r in rows)
        if total:
            mean = sum(np.frombuffer(r["weights"], "<f4").astype(np.float64) * r["tokens"] for r in rows)
            weights = (mean / total).astype("<f4").tobytes()
    return weights


def _network_scores(df: DataFrame, words: list[str], weights: bytes) -> DataFrame:
    """row (a number of its own), doc_id, n_tokens, ids (log-likelihood of the ids), and the rare words by hash."""
    held = df.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        net, vocabulary = Network.unpacked(held.value), Words(words)
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, 400):
            places, sizes = vocabulary.places_of(batch.column(1))
            context, target = windows(np.split(vocabulary.ids[places], np.cumsum(sizes)[:-1]))
            logs = np.concatenate([np.zeros(0), *(net.logprobs(context[at:at + _SCORED], target[at:at + _SCORED])
                                                  for at in range(0, len(target), _SCORED))])
            ends = np.cumsum(sizes)
            total = np.concatenate(([0.0], np.cumsum(logs)))
            sums = total[ends] - total[ends - sizes]
            # The words without an id of their own, once a document, with their occurrences there.
            rare = places >= len(words)
            width = len(vocabulary.ids)
            pairs, times = np.unique(np.repeat(np.arange(len(sizes)), sizes)[rare] * width + places[rare],
                                     return_counts=True)
            cuts = pa.array(np.searchsorted(pairs, np.arange(len(sizes) + 1) * width), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(len(sizes))), batch.column(0), pa.array(sizes.astype(np.int64)), pa.array(sums),
                 pa.ListArray.from_arrays(cuts, pa.array(vocabulary.hashes[pairs % width])),
                 pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32)))],
                ["row", "doc_id", "n_tokens", "ids", "rare", "times"])
            row += len(sizes)
            vocabulary.make_room()

    return stored(map_arrow(df, run, "row long, doc_id long, n_tokens long, ids double, rare array<long>, times array<int>"),
                  "lm-scores")


def score(df: DataFrame, counts: DataFrame, words: list[str], weights: bytes, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, log_likelihood (sum over the tokens), mean_logprob.

    ``counts`` are the words of a corpus that holds these texts (a rare word that
    it lacks adds nothing to the score).
    """
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = _network_scores(texts, words, weights)
    met = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("m"))
    met = met.select("row", F.col("m.rare").alias("h"), F.col("m.times").alias("times"))
    inside = (met.join(rare_shares(counts, words), "h")
              .groupBy("row").agg(F.sum(F.col("times") * F.col("share")).alias("inside")))
    whole = F.col("ids") + F.coalesce("inside", F.lit(0.0))
    return (scored.select("row", "doc_id", "n_tokens", "ids").join(inside, "row", "left")
            .select("doc_id", "n_tokens", whole.alias("log_likelihood"),
                    F.when(F.col("n_tokens") > 0, whole / F.col("n_tokens")).alias("mean_logprob")))


def report(df: DataFrame) -> DataFrame:
    """Word counts, training and scores, all over the whole of ``df``."""
    counts = word_counts(df)
    words = vocabulary(counts)
    return score(df, counts, words, train(df, words))
