"""Language identification with bit-sliced n-gram Bloom filters.

Fitting: a bounded sample of labelled rows per language gives the relative
frequencies of its letter n-grams.  A language's set are the n-grams that make
up at least ``min_share`` of its text, and at least ``min_ratio`` of the share
they have in the language that uses them most.  Each share bounds the number
of n-grams kept (no more than 1 / ``min_share`` a language), so the filters'
size depends on the languages, not on the data.

The sets are one bit-sliced Bloom filter: a table of language bitmasks, in
which the masks at an n-gram's positions, and-ed, are all languages that
contain it (and a few false ones).  A text's hits are summed per language bit,
corrected for the false-positive rate of that language's slice, and the
language with the most hits is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import bounded_sample, keep_rows, seeds, splitmix, written
from emporia.session import ship_package

UNDETERMINED = "und"
BLANK = 32
#: Characters looked at together: long texts are read piece by piece.
PIECE_CHARS = 1 << 19


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letter of each code point, a blank for what isn't a letter."""
    out = np.full(0x110000, BLANK, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            out[i] = ord(c.lower()[0])
    return out


def _pieces(text: str) -> Iterator[str]:
    """The whole text in pieces that end at blanks where there are any."""
    at = 0
    while at < len(text):
        end = at + PIECE_CHARS
        if end < len(text):
            blank = text.rfind(" ", at + 1, end)
            end = blank if blank > 0 else end
        yield text[at:end]
        at = end


def grams(text: str, sizes: tuple[int, ...]) -> np.ndarray:
    """Hashes of the n-grams of letters, a blank standing for what is between
    words; n-grams that cross a word boundary are left out."""
    found = []
    factor = seeds(max(sizes) + 1, 21) | np.uint64(1)
    for piece in _pieces(text):
        codes = _letters()[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)]
        padded = np.empty(len(codes) + 2, np.uint64)
        padded[0] = padded[-1] = BLANK
        padded[1:-1] = codes
        blank = padded == BLANK
        padded = padded[np.append(True, ~(blank[1:] & blank[:-1]))]
        blank = padded == BLANK
        for size in sizes:
            n = len(padded) - size + 1
            if n <= 0:
                continue
            total = np.full(n, size, np.uint64) * factor[-1]
            inside = np.ones(n, bool)
            for i in range(size):
                total += padded[i:i + n] * factor[i]
                if 0 < i < size - 1:
                    inside &= ~blank[i:i + n]
            found.append(splitmix(total[inside]))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


@dataclass
class LanguageModel:
    """``masks``: one row of language bits (in 64-bit words) per position."""

    languages: list[str]
    masks: np.ndarray
    hashes: int
    sizes: tuple[int, ...]
    false_rate: np.ndarray
    fallback: str | None

    @staticmethod
    def build(grams_of: list[np.ndarray], languages: list[str], fallback: str | None,
              sizes: tuple[int, ...], hashes: int = 4) -> LanguageModel:
        """``grams_of``: the n-grams (64-bit hashes) of each of ``languages``."""
        most = max((len(g) for g in grams_of), default=0)
        positions = 1 << max(10, int(np.ceil(np.log2(max(1, most) * 3 * hashes))))
        model = LanguageModel(languages, np.zeros((max(1, -(-len(languages) // 64)), positions), np.uint64),
                              hashes, sizes, np.zeros(len(languages)), fallback)
        for k, own in enumerate(grams_of):
            for at in model._positions(own):
                model.masks[k >> 6, at] |= np.uint64(1 << (k & 63))
        for k in range(len(languages)):
            filled = (model.masks[k >> 6] >> np.uint64(k & 63)) & np.uint64(1)
            model.false_rate[k] = min(0.99, float(filled.mean()) ** hashes)
        return model

    def _positions(self, h: np.ndarray) -> list[np.ndarray]:
        size = np.uint64(self.masks.shape[1] - 1)
        step = splitmix(h) | np.uint64(1)
        return [(h + np.uint64(i) * step) & size for i in range(self.hashes)]

    def languages_of(self, h: np.ndarray) -> np.ndarray:
        """Bitmask words (row per word) of the languages containing each n-gram."""
        at = self._positions(h)
        out = self.masks[:, at[0]]
        for a in at[1:]:
            out &= self.masks[:, a]
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and share of the text's n-grams that speak for it."""
        if not text or not self.languages:
            return UNDETERMINED, 0.0
        h = grams(text, self.sizes)
        if not len(h):  # no letter at all
            return UNDETERMINED, 0.0
        hits = np.zeros(len(self.languages))
        for at in range(0, len(h), PIECE_CHARS):
            masks = self.languages_of(h[at:at + PIECE_CHARS])
            for k in range(len(self.languages)):
                hits[k] += np.count_nonzero(masks[k >> 6] & np.uint64(1 << (k & 63)))
        true = (hits - len(h) * self.false_rate) / (1 - self.false_rate)
        best = int(np.argmax(true))
        if true[best] <= 0:
            return self.fallback or UNDETERMINED, 0.0
        return self.languages[best], float(min(1.0, true[best] / len(h)))


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", rows_per_language: int = 1000, sizes: tuple[int, ...] = (3, 4),
                  min_share: float = 2e-5, min_ratio: float = 0.1, max_languages: int = 512) -> LanguageModel:
    """Learn from ``docs`` (rows with null language or text teach nothing).

    ``rows_per_language`` bounds the sample: the rows with the smallest hashed
    identifiers (ties, nulls and repeated ones in any order).  More than
    ``max_languages`` languages are an error.
    """
    ship_package(docs.sparkSession)
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("h"))
    sample = written(bounded_sample(labelled, "lang", rows_per_language, max_languages).distinct(), "language-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for lang, text in zip(batch.column(0), batch.column(1)):
                    h, n = np.unique(grams(text.as_py(), sizes), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang.as_py()] * len(h), pa.string()), pa.array(h.view(np.int64)), pa.array(n)],
                        ["lang", "gram", "n"])

    texts = docs.select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("h"),
                        F.col(text_col).alias("text")).where("text is not null").join(
        sample, ["lang", "h"], "left_semi")
    counts = written(texts.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
                     .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")
    share = counts.join(counts.groupBy("lang").agg(F.sum("n").alias("all")), "lang").select(
        "lang", "gram", (F.col("n") / F.col("all")).alias("share"))
    top = share.groupBy("gram").agg(F.max("share").alias("top"))
    kept = (share.where(F.col("share") >= min_share).join(top, "gram")
            .where(F.col("share") >= F.col("top") * min_ratio))
    languages = sorted((r["lang"], r["n"]) for r in sample.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n")).collect())
    fallback = max(languages, key=lambda x: (x[1], x[0]))[0] if languages else None
    # at most 1 / min_share n-grams a language, as Arrow columns: a position of the list and a hash
    names = [name for name, _ in languages]
    found = kept.select((F.array_position(F.array(*map(F.lit, names)), F.col("lang")) - 1).cast("int").alias("k")
                        if names else F.lit(0).alias("k"), "gram").toArrow()
    k, gram = (found.column(c).to_numpy() for c in ("k", "gram"))
    order = np.argsort(k, kind="stable")
    grams_of = np.split(gram[order].view(np.uint64), np.searchsorted(k[order], np.arange(1, len(names)))) if names else []
    with np.errstate(over="ignore"):
        return LanguageModel.build(grams_of, names, fallback, sizes)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per input row: the identifier, ``lang_pred`` and ``score`` (the
    share, 0 to 1, of n-grams that speak for the language).

    ``und`` with score 0 for a null, empty or letterless text, and for every
    text if nothing was learned.  A text with letters but without any known
    n-gram gets the language with the most sampled rows, with score 0.  Null
    and repeated identifiers pass through; other columns are not read.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                found = [model.predict(t.as_py()) for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([x for x, _ in found], pa.string()),
                     pa.array([x for _, x in found], pa.float64())], ["id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text",
                    min_score: float = 0.1) -> DataFrame:
    """The rows of ``docs``, all columns, with a language: neither ``und`` nor
    a score under ``min_score``."""
    def judge():
        def passes(texts: list[str | None]) -> list[bool]:
            with np.errstate(over="ignore"):
                found = [model.predict(t) for t in texts]
            return [lang != UNDETERMINED and score >= min_score for lang, score in found]

        return passes

    return keep_rows(docs, text_col, judge)
