"""Language identification by prediction by partial matching over bytes.

Every language has a tree of byte contexts of up to ``ORDER`` bytes with the
counts of the bytes that followed (the training sample: the ``SAMPLE`` first
documents of each language in hash order). A byte is coded in the longest
context seen; a byte new there costs an escape and is coded one byte shorter,
without the bytes already ruled out (method C: a context of n bytes and d
distinct ones escapes with d / (n + d)), down to equal chances of 256. After training
the counts are frozen, so a code length depends on the context and the byte
only; they are worked out once, as a table, and whole texts are scored by
looking every byte up. The language with the shortest code wins.

``lang_pred`` is ``und``, with score 0, where the text is null or has no
letter; also where nothing was learned. Languages of equal code length: the
first by name. ``score`` is the winner's share when each language has
the weight 2 ** -(bits per text, at most ``EVIDENCE`` bytes' worth of them).
Repeated rows are scored alike; null languages are not learned from.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.llm.common import map_columns, whole_text

ORDER = 3
SAMPLE = 400  # training documents of a language at most
SAMPLE_BYTES = 20_000  # of each training document
EVIDENCE = 200
FOLDS = 5
MOST_BITS = 6.0  # per byte; a text that costs more is in no learned language
LEAST_SCORE = 0.5
TABLE_BYTES = 200 << 20  # of code lengths
_LETTER = regex.compile(r"\p{L}")


def held_out() -> Column:
    """Documents that are never learned from; a null doc_id counts as the text "null"."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) % FOLDS == 0


def training_sample(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """lang and text of the ``sample`` first documents of each language in hash order.

    Spark cuts each language to ``sample`` ids in every task before it
    shuffles; only the ids chosen are joined back to the texts.
    """
    labelled = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        labelled.select("doc_id", "lang").withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") <= sample)
    )
    return labelled.join(F.broadcast(chosen.select("doc_id", "lang").distinct()), ["doc_id", "lang"]).select(
        "lang", F.substring(F.encode("text", "UTF-8"), 1, SAMPLE_BYTES).alias("bytes")
    )


def context_counts(sample: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram (a context of 0 to ``order`` bytes and the byte after it), n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data in zip(*[c.to_pylist() for c in batch.columns]):
                symbols = np.frombuffer(data, np.uint8).astype(np.int64)
                for length in range(1, order + 2):
                    if len(symbols) < length:
                        break
                    grams = np.zeros(len(symbols) - length + 1, np.int64)
                    for i in range(length):
                        grams = (grams << 8) | symbols[i : len(symbols) - length + 1 + i]
                    gram, n = np.unique(grams, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(gram)), pa.array([length] * len(gram), pa.int32()), pa.array(gram), pa.array(n, pa.int64())],
                        names=["lang", "length", "gram", "n"],
                    )

    counted = sample.mapInArrow(count, "lang string, length int, gram long, n long")
    return counted.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Frozen code lengths: cost[state, byte class] has the bits of every language."""

    langs: list[str]
    order: int
    classes: np.ndarray  # byte -> class
    states: np.ndarray  # code of ``order`` classes -> state
    costs: np.ndarray  # (state * classes + class, language)

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language, a block of bytes at a time."""
        n = int(self.classes.max()) + 1
        out = np.zeros((len(texts), len(self.langs)))
        # a text begins after line ends, which cost nothing themselves
        data = np.frombuffer(b"".join([b"\n" * self.order + t for t in texts]), np.uint8)
        size = np.array([self.order + len(t) for t in texts])
        ends = np.cumsum(size)
        for at in range(0, len(data), _BLOCK):
            stop, low = min(len(data), at + _BLOCK), max(0, at - self.order)
            codes = self.classes[data[low:stop]]
            context = np.zeros(len(codes), np.int64)
            for back in range(self.order, 0, -1):
                context *= n
                context[back:] += codes[:-back] if back < len(codes) else 0
            cost = self.costs[self.states[context].astype(np.int64) * n + codes][at - low :]
            first, last = np.searchsorted(ends, [at, stop - 1], side="right")
            begins = (ends - size)[first : last + 1] - at
            ahead = (begins[:, None] + np.arange(self.order)).ravel()
            cost[ahead[(ahead >= 0) & (ahead < stop - at)]] = 0
            starts = np.maximum(begins, 0)
            out[first : last + 1] += np.add.reduceat(cost, starts, axis=0, dtype=np.float64)
        return out

    def judged(self, texts: list[str]) -> Iterator[tuple[str, float, float]]:
        """Language, score and bits per byte of each text."""
        data = [t.encode("utf-8", "surrogatepass") for t in texts]
        for text, own, bits in zip(texts, data, self.bits(data) if data else ()):
            if not _LETTER.search(text):
                yield "und", 0.0, 0.0
                continue
            best = int(bits.argmin())
            gap = np.minimum(1000.0, (bits - bits[best]) * min(1.0, EVIDENCE / len(own)))
            yield self.langs[best], 1.0 / float(np.exp2(-gap).sum()), float(bits[best]) / len(own)


_BLOCK = 1 << 20


def trained(counts: list[tuple[str, int, int, int]], order: int = ORDER) -> Model | None:
    """The model from rows of ``context_counts``."""
    langs = sorted({row[0] for row in counts})
    if not langs:
        return None
    number = {lang: i for i, lang in enumerate(langs)}
    seen = sorted({row[2] for row in counts if row[1] == 1} | {10})
    classes = np.full(256, len(seen), np.int64)  # the last class: bytes never seen
    classes[seen] = np.arange(len(seen))
    n, k = len(seen) + 1, len(langs)
    unseen = 256 - len(seen)  # bytes in the last class

    def coded(gram: int, length: int) -> tuple[int, ...]:
        return tuple(int(classes[(gram >> (8 * (length - 1 - i))) & 255]) for i in range(length))

    tree: list[dict[tuple[int, ...], dict[int, int]]] = [{} for _ in langs]
    for lang, length, gram, count in counts:
        *context, byte = coded(gram, length)
        tree[number[lang]].setdefault(tuple(context), {})[byte] = count
    often: dict[tuple[int, ...], int] = {}
    for own in tree:
        for c, followed in own.items():
            often[c] = often.get(c, 0) + sum(followed.values())
    # the table is bounded: beyond that, rare contexts count as not seen
    most = max(1, TABLE_BYTES // (4 * n * k))
    contexts = sorted(sorted(often, key=lambda c: (len(c) > 0, -often[c], c))[:most], key=lambda c: (len(c), c))
    place = {c: i for i, c in enumerate(contexts)}
    costs = np.zeros((len(contexts), n, k), np.float32)
    for i, own in enumerate(tree):
        for c, at in place.items():
            costs[at, :, i] = -np.log2(_chances(own, c, n, unseen))
    # the state of a full context: its longest part that is in a tree
    states = np.zeros(n**order, np.int32)
    for length in range(1, order + 1):
        span = n ** (order - length)
        by_code = states.reshape(span, n**length)
        for c in (c for c in contexts if len(c) == length):
            code = 0
            for symbol in c:
                code = code * n + symbol
            by_code[:, code] = place[c]
    return Model(langs, order, classes, states, costs.reshape(-1, k))


def _chances(tree: dict[tuple[int, ...], dict[int, int]], context: tuple[int, ...], n: int, unseen: int) -> np.ndarray:
    """The chance of each byte class after a context, by escapes with exclusion."""
    chance = np.zeros(n)
    out = np.zeros(n, bool)  # ruled out: coded in a longer context if at all
    left = 1.0
    for start in range(len(context) + 1):
        followed = tree.get(context[start:])
        if not followed:
            continue
        symbols = np.fromiter(followed, np.int64, len(followed))
        number = np.fromiter(followed.values(), np.float64, len(followed))
        new = ~out[symbols]
        symbols, number = symbols[new], number[new]
        if not len(symbols):
            continue
        total = number.sum() + len(symbols)
        chance[symbols] = left * number / total
        left *= len(symbols) / total
        out[symbols] = True
    rest = ~out
    bytes_left = rest[:-1].sum() + unseen  # the last class holds ``unseen`` bytes
    chance[rest] = left / bytes_left if bytes_left else 1.0
    return np.maximum(chance, 1e-12)


def model(docs: DataFrame, sample: int = SAMPLE, order: int = ORDER) -> Model | None:
    """Trained on a bounded sample; its counts, and so what comes here, are bounded too."""
    rows = context_counts(training_sample(docs, sample), order).collect()
    return trained([tuple(row) for row in rows], order)


def predicted(docs: DataFrame, sample: int = SAMPLE, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte of every row."""
    fitted = docs.sparkSession.sparkContext.broadcast(model(docs, sample, order))

    def rows(doc_ids, held, texts):
        learned = fitted.value
        found = learned.judged(texts) if learned else [("und", 0.0, 0.0)] * len(texts)
        for doc_id, out, one in zip(doc_ids, held, found):
            yield doc_id, out, *one

    return map_columns(
        docs.select("doc_id", held_out().alias("held_out"), whole_text().alias("text")),
        "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double",
        rows, most=1 << 20,
    )


def accepted(docs: DataFrame, sample: int = SAMPLE, order: int = ORDER) -> DataFrame:
    """The rows whose language is known, with all their columns; nothing is shuffled.

    Rejected are ``und``, texts that no learned language explains (more than
    ``MOST_BITS`` a byte), and those where no language has half of the weight.
    """
    fitted = docs.sparkSession.sparkContext.broadcast(model(docs, sample, order))
    names = docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * _BLOCK // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                texts = [t or "" for t in part.column(names.index("text")).to_pylist()]
                mask = [
                    lang != "und" and score >= LEAST_SCORE and bits <= MOST_BITS
                    for lang, score, bits in fitted.value.judged(texts)
                ] if fitted.value else [False] * len(texts)
                yield part.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
