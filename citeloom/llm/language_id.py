"""Language identification with a bit-sliced Bloom filter of character n-grams.

The filter is one array of language bitmasks. A language's characteristic n-grams set that
language's bit in a few slots each; and-ing the slots of an n-gram of a text returns the mask of all
languages that contain it. The population count of each language's bit over the whole text, minus
the hits that false positives account for at that language's fill, decides.

Training counts n-grams of a bounded, documented sample of labelled rows (``SAMPLE_DOCS`` documents
a language, chosen by the hash of their ids); an n-gram is characteristic of a language if its share
there is at least ``SHARE`` of its summed shares in all languages.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a text with letters
whose n-grams all miss gets the language with most training documents, score 0; equal evidence goes
to the language that sorts first; rows without label or text train nothing; without any labelled
row every text is ``und``; repeated rows and null ids are predicted like others; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import bound_batches, drop_staged, stage
from citeloom.llm.shingles import mix, text_chunks

GRAM = 4
#: Bound of the training sample: documents of each language.
SAMPLE_DOCS = 1500
#: N-grams kept of each language, the most frequent ones; the filter's size follows.
GRAMS_KEPT = 60_000
MIN_COUNT = 4
SHARE = 0.5
SLOT_BITS = 20
HASHES = 2
#: Most languages that a filter is built for; a mask holds 64, so there are as many masks as needed.
MAX_LANGUAGES = 512
UNDETERMINED = "und"

_IS_LETTER = np.zeros(0x110000, bool)
_LOWERED = np.arange(0x110000, dtype=np.uint32)
_TABLES_READY = False


def _tables() -> None:
    """Letters and lower case of all code points, from the Unicode data of Python."""
    global _TABLES_READY
    if not _TABLES_READY:
        _IS_LETTER[:] = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)
        for c in np.flatnonzero(_IS_LETTER).tolist():
            low = chr(c).lower()
            if len(low) == 1:
                _LOWERED[c] = ord(low)
        _TABLES_READY = True


def gram_hashes(column: pa.Array) -> Iterator[tuple[np.ndarray, bool]]:
    """For each text the hashes of its n-grams, and whether it has a letter.

    N-grams run over lower-case letters and word borders: every run of other characters is one
    border, and an n-gram has no border inside.
    """
    _tables()
    for _, data, offsets in text_chunks(column):
        # A space on either side of each text is its outer word border.
        sizes = np.diff(offsets)
        spaced = np.full(len(data) + 2 * len(sizes), 0x20, np.uint8)
        spaced[np.arange(len(data)) + 1 + 2 * np.repeat(np.arange(len(sizes)), sizes)] = data
        data, offsets = spaced, offsets + 2 * np.arange(len(offsets))
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        # Offsets count bytes; code points begin at every byte that continues no other.
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        letter = _IS_LETTER[codes]
        low = np.where(letter, _LOWERED[codes], 0).astype(np.uint64)
        n = len(low)
        width = GRAM
        if n < width:
            for a, b in zip(at[:-1], at[1:], strict=True):
                yield np.zeros(0, np.uint64), bool(letter[a:b].any())
            continue
        hashed = np.zeros(n - width + 1, np.uint64)
        inner = np.ones(n - width + 1, bool)
        for k in range(width):
            hashed = hashed * np.uint64(0x100000001B3 + 0x2000) + low[k : n - width + 1 + k]
            if 0 < k < width - 1:
                inner &= letter[k : n - width + 1 + k]
        hashed = mix(hashed)
        for a, b in zip(at[:-1], at[1:], strict=True):
            last = max(a, b - width + 1)
            yield hashed[a:last][inner[a:last]], bool(letter[a:b].any())


# --- training ------------------------------------------------------------------------------------


def _count_grams(languages: list[str]):
    number = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, (grams, _) in zip(batch.column(1).to_pylist(), gram_hashes(batch.column(0)), strict=True):
                if len(grams):
                    gram, count = np.unique(grams, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(np.full(len(gram), number[lang], np.int32)), pa.array(count)], names=["gram", "lang", "n"])

    return run


class Model:
    """Languages, their bit-sliced Bloom filter and each language's false-positive rate."""

    def __init__(self, languages: list[str], slots: np.ndarray, default: int):
        """``slots``: one array of masks for every 64 languages."""
        self.languages, self.slots, self.default = languages, np.atleast_2d(slots), default
        # The chance that an n-gram foreign to a language hits all its slots.
        self.false_rate = np.array([((self.slots[b // 64] >> np.uint64(b % 64) & np.uint64(1)) != 0).mean() ** HASHES for b in range(len(languages))])

    def masks(self, grams: np.ndarray, plane: int = 0) -> np.ndarray:
        found = self.slots[plane][_slot(grams, 0)]
        for k in range(1, HASHES):
            found = found & self.slots[plane][_slot(grams, k)]
        return found

    def hits(self, grams: np.ndarray) -> np.ndarray:
        """For each language the number of n-grams whose mask has its bit."""
        out: list[int] = []
        for plane in range(len(self.slots)):
            masks = self.masks(grams, plane)
            masks, times = np.unique(masks, return_counts=True) if len(masks) > 64 else (masks, np.ones(len(masks), np.int64))
            here = min(64, len(self.languages) - 64 * plane)
            out += [times[(masks >> np.uint64(b) & np.uint64(1)) != 0].sum() for b in range(here)]
        return np.array(out)

    def predict(self, grams: np.ndarray, has_letter: bool) -> tuple[str, float, float]:
        """(language, its share of the corrected hits, its corrected hits for each n-gram)."""
        if not has_letter or not self.languages:
            return UNDETERMINED, 0.0, 0.0
        if not len(grams):
            return self.languages[self.default], 0.0, 0.0
        hits = self.hits(grams)
        real = np.maximum(0.0, (hits - len(grams) * self.false_rate) / (1 - self.false_rate))
        if not real.any():
            return self.languages[self.default], 0.0, 0.0
        best = int(np.argmax(real))
        return self.languages[best], float(min(1.0, real[best] / real.sum())), float(min(1.0, real[best] / len(grams)))


def _slot(grams: np.ndarray, k: int) -> np.ndarray:
    return (grams >> np.uint64(k * 24) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """Fit the filter on a bounded sample of labelled rows; ids only choose the sample."""
    bound_batches(rows.sparkSession)
    labelled = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h")).filter("text IS NOT NULL AND lang IS NOT NULL")
    docs = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()}
    languages = sorted(docs)
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not languages:
        return Model([], np.zeros(1 << SLOT_BITS, np.uint64), 0)
    # Hashes are uniform, so a bound on them holds about as many documents as are wanted.
    bound = F.lit(None).cast("double")
    for x in languages:
        bound = F.when(F.col("lang") == x, F.lit(min(1.0, SAMPLE_DOCS / docs[x]))).otherwise(bound)
    sample = labelled.filter(F.pmod("h", F.lit(1 << 30)) < bound * (1 << 30)).select("text", "lang")
    counts = sample.mapInArrow(_count_grams(languages), "gram long, lang int, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    kept = counts.filter(F.col("n") >= MIN_COUNT)
    total = counts.groupBy("lang").agg(F.sum("n").alias("all"))
    share = kept.join(F.broadcast(total), "lang").withColumn("share", F.col("n") / F.col("all"))  # one row a language: 64 at most
    whole = share.groupBy("gram").agg(F.sum("share").alias("whole"))
    clear = stage(share.join(whole, "gram").filter(F.col("share") >= SHARE * F.col("whole")).select("lang", "gram", "n"), "grams")
    slots = np.zeros((-(-len(languages) // 64), 1 << SLOT_BITS), np.uint64)
    first = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    best = clear.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= GRAMS_KEPT).select("lang", "gram")
    for lang, grams in best.toPandas().groupby("lang")["gram"]:  # GRAMS_KEPT a language at most
        for k in range(HASHES):
            slots[lang // 64, _slot(grams.to_numpy(np.int64).view(np.uint64), k)] |= np.uint64(1) << np.uint64(lang % 64)
    drop_staged(clear)
    return Model(languages, slots, max(range(len(languages)), key=lambda i: (docs[languages[i]], -i)))


# --- prediction ----------------------------------------------------------------------------------


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.predict(*x) for x in gram_hashes(batch.column(1))]
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "lang_pred", "score", "hit_rate"])

    return run


def identify(df: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id, ``lang_pred``, ``score`` (0 to 1) and ``hit_rate``.

    ``hit_rate`` is the share of the text's n-grams that the language accounts for.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # a filter of fixed size
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(_predict(shared), f"id {kind}, lang_pred string, score double, hit_rate double")
    return out.withColumnRenamed("id", id_col)


def _keep(shared, at: int, min_hit_rate: float, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(at)
            sizes = pc.utf8_length(texts).to_pylist()
            found = [model.predict(*x) for x in gram_hashes(texts)]
            keep = [lang != UNDETERMINED and (n < min_chars or rate >= min_hit_rate) for (lang, _, rate), n in zip(found, sizes, strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def known_rows(df: DataFrame, model: Model, min_hit_rate: float, min_chars: int, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text is in a learned language, with all their columns.

    Rejected are null texts, texts without a letter, and texts of ``min_chars`` characters or more
    of whose n-grams their language accounts for less than ``min_hit_rate``.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    return df.mapInArrow(_keep(shared, df.columns.index(text_col), min_hit_rate, min_chars), df.schema)


def held_out(id_col: str = "doc_id"):
    """Whether a document is held out of training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
