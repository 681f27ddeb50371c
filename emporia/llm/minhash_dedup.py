"""MinHash near-dedup with odd sketches.

A document's set is its distinct word shingles.  Documents with the same set
form a class, represented by its smallest identifier (with a hash of the text,
since an identifier may come with several); only representatives
are compared.  For each, one pass over the text gives MinHash samples; bands
of them are the bucket keys, and all of them are folded into an odd sketch: a
parity bitmap in which each (sample number, sample value) flips one bit.  The
XOR of two sketches has about as many bits set as the two documents have
differing samples, so its population count estimates high similarities
precisely from 128 bytes; candidates whose count is more than 5.5 standard
deviations beyond what the threshold allows are dropped unread.  The rest are
confirmed on the whole texts' word shingles.

Groups are never expanded into pairs.  In each round every bucket compares its
members with one centre; confirmed links are contracted to components, and
only buckets that still hold several components go on.  After two rounds with
different centres the members of the remaining buckets get a finer sketch of
more samples, and blocks of them are compared with blocks: those outside the
bucket's largest component with each other and with those inside, which never
meet one another.  The pairs of different components that the finer sketch can't
tell from links are confirmed.  A bucket of any size is dealt over its pairs of
blocks, and no candidate is capped.

Band counts are derived from the threshold so that a pair exactly at it shares
no bucket with probability below ``miss``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.blocks import deal_apart, groups_of, matrix
from emporia.llm.common import seeds, splitmix, written
from emporia.llm.components import connected_components
from emporia.session import ship_package

SKETCH_BITS, SAMPLES = 1024, 160
FINE_BITS, FINE_SAMPLES = 4096, 1024
#: Members of a bucket in one block, and rows of it compared at once.
BLOCK, STRIPE = 2048, 256
WORD_CACHE = 1 << 17


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z (bytes.lower and
    bytes.split know exactly these letters and blanks)."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size))))


class Signer:
    """Shingle hashes, MinHash bands and odd sketch of one text."""

    def __init__(self, size: int, rows: int, bands: int, samples: int = SAMPLES, bits: int = SKETCH_BITS):
        self.size, self.rows, self.bands, self.bits = size, rows, bands, bits
        self.samples = max(samples, rows * bands)
        self.place = seeds(size + 1, 1) | np.uint64(1)
        self.factors = (seeds(self.samples, 2) | np.uint64(1))[:, None]
        self.fold = seeds(self.samples, 3)
        self.band_mix = seeds(rows, 4) | np.uint64(1)
        self.band_salt = seeds(bands, 5)
        self.words: dict[bytes, int] = {}

    def hashes(self, text: str | None) -> np.ndarray:
        """Distinct 64-bit hashes of the shingles."""
        words = words_of(text)
        if not words:
            return np.empty(0, np.uint64)
        known, digest = self.words, xxhash.xxh3_64_intdigest
        if len(known) > WORD_CACHE:
            known.clear()
        for w in set(words).difference(known):
            known[w] = digest(w) >> 1
        h = splitmix(np.array([known[w] for w in words], np.int64).view(np.uint64))
        if len(h) < self.size:
            return splitmix((h * seeds(len(h), 6 + len(h))).sum(keepdims=True) + self.place[-1])
        n = len(h) - self.size + 1
        total = np.zeros(n, np.uint64)
        for i in range(self.size):
            total += h[i:i + n] * self.place[i]
        return np.unique(splitmix(total))

    def minhash(self, h: np.ndarray) -> np.ndarray:
        low = np.full(self.samples, np.iinfo(np.uint64).max)
        for at in range(0, len(h), 1024):
            np.minimum(low, (h[at:at + 1024] * self.factors).min(axis=1), out=low)
        return low

    def band_keys(self, low: np.ndarray) -> np.ndarray:
        used = low[:self.rows * self.bands].reshape(self.bands, self.rows)
        return splitmix((used * self.band_mix).sum(axis=1, dtype=np.uint64) ^ self.band_salt)

    def sketch(self, low: np.ndarray) -> np.ndarray:
        """Parity bitmap of the samples, as 64-bit words."""
        at = splitmix(low ^ self.fold) % np.uint64(self.bits)
        odd = np.bincount(at.astype(np.int64), minlength=self.bits) & 1
        return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def bands_for(threshold: float, miss: float) -> tuple[int, int]:
    """(rows, bands): rows such that a pair at the threshold shares a band
    about as often as not, bands such that it misses all of them with
    probability under ``miss``."""
    rows = max(1, round(math.log(0.45) / math.log(threshold)))
    return rows, math.ceil(math.log(miss) / math.log(1 - threshold ** rows))


def sketch_limit(samples: int, bits: int, threshold: float) -> int:
    """Largest XOR population count of a pair at the threshold, 5.5 standard
    deviations (of the samples that differ, and of the folding) allowed."""
    m = 2 * samples * (1 - threshold)
    spread = math.exp(-2 * m / bits) * 2 * math.sqrt(samples * threshold * (1 - threshold))
    folding = 2 * math.sqrt(m * m / (2 * bits))
    return math.ceil(bits / 2 * (1 - math.exp(-2 * m / bits)) + 5.5 * math.hypot(spread, folding))


def _lists(parts: list[np.ndarray], width: int) -> pa.ListArray:
    flat = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(parts) + 1, dtype=np.int32) * width), pa.array(flat))


def _signatures(docs: DataFrame, id_col: str, text_col: str, size: int, rows: int,
                bands: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(size, rows, bands)
        with np.errstate(over="ignore"):
            for batch in batches:
                n, f1, f2, keys, bits = [], [], [], [], []
                for text in batch.column(2):
                    h = signer.hashes(text.as_py())
                    n.append(len(h))
                    f1.append(h.sum(dtype=np.uint64))
                    f2.append(splitmix(h + signer.place[0]).sum(dtype=np.uint64))
                    low = signer.minhash(h)
                    keys.append(signer.band_keys(low))
                    bits.append(signer.sketch(low))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(n, pa.int64()),
                     pa.array(np.array(f1, np.uint64).view(np.int64)),
                     pa.array(np.array(f2, np.uint64).view(np.int64)),
                     _lists(keys, bands), _lists(bits, SKETCH_BITS // 64)],
                    ["id", "t", "n", "f1", "f2", "keys", "bits"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _with_texts(docs, id_col, text_col).mapInArrow(
        sign, f"id {kind}, t long, n long, f1 long, f2 long, keys array<long>, bits array<long>")


def _with_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, t, text): ``t`` tells the texts of one identifier apart."""
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))


def _confirm(pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) of the rows (a, b, ta, tb) whose shingle sets have
    100 * intersection >= percent * union."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_id, last_set = None, None
        for batch in batches:
            a, b, ta, tb = batch.columns
            keep = []
            for i in range(batch.num_rows):
                if last_set is None or a[i].as_py() != last_id:
                    last_id, last_set = a[i].as_py(), shingle_set(ta[i].as_py(), size)
                other = shingle_set(tb[i].as_py(), size)
                common = len(last_set & other)
                keep.append(100 * common >= percent * (len(last_set) + len(other) - common))
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.select("a", "b", "ta", "tb").mapInArrow(check, f"a {kind}, b {kind}")


def _fine_sketches(texts: DataFrame, size: int) -> DataFrame:
    """(rep, fine) of the rows (rep, text)."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(size, 1, 1, FINE_SAMPLES, FINE_BITS)
        with np.errstate(over="ignore"):
            for batch in batches:
                bits = [signer.sketch(signer.minhash(signer.hashes(t.as_py()))) for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists(bits, FINE_BITS // 64)], ["rep", "fine"])

    return texts.mapInArrow(sketch, f"rep {texts.schema['rep'].dataType.simpleString()}, fine array<long>")


def _close_in_blocks(members: DataFrame, limit: int) -> DataFrame:
    """(a, b) of the members of a bucket, of different components, whose fine
    sketches differ in ``limit`` bits at most; each pair in the first bucket
    that both are in.  ``members``: key, rest and big (the bucket's members
    outside and inside its largest component), inside, rep, c, keys, fine.
    Members of the largest component meet those outside it only."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, found in groups_of(batches):
            number: dict[tuple, int] = {}
            c = np.array([number.setdefault(tuple(x.values()), len(number)) for x in rows.column("c").to_pylist()], np.int64)
            keys, fine = matrix(rows, "keys"), np.ascontiguousarray(matrix(rows, "fine").view(np.uint64).T)
            left, right = [], []
            for key, one, two in found:
                for k in range(0, len(one), STRIPE):
                    some = one[k:k + STRIPE]
                    differ = np.zeros((len(some), len(two)), np.uint16)
                    for word in fine:
                        differ += np.bitwise_count(word[some][:, None] ^ word[two][None, :])
                    i, j = np.nonzero((differ <= limit) & (c[some][:, None] != c[two][None, :]))
                    i, j = some[i], two[j]
                    if one is two:
                        i, j = i[i < j], j[i < j]
                    if len(i):
                        shared = np.argmax(keys[i] == keys[j], axis=1)
                        first = keys[i, shared] == key
                        left.append(i[first])
                        right.append(j[first])
            if left:
                rep = rows.column("rep").combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [rep.take(pa.array(np.concatenate(left))), rep.take(pa.array(np.concatenate(right)))], ["a", "b"])

    kind = members.schema["rep"].dataType.simpleString()
    near = deal_apart(members, BLOCK).mapInArrow(compare, f"a {kind}, b {kind}")
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """One row per input row: the identifier, ``n_shingles``, ``component_id``
    (smallest identifier reachable by links of Jaccard similarity of at least
    ``percent`` / 100, itself included) and ``kept``.

    A text of fewer than ``shingle`` words is one shingle; a null, empty or
    blank text has none, links with nothing and is kept.  A row with a null
    identifier links with nothing, has a null component and is kept.  Rows
    that repeat an identifier get the same answer if their texts agree, and
    are members of each of their texts' classes if not.  Other columns are
    not read; an empty table gives an empty result.
    """
    answer = _answers(docs, id_col, text_col, shingle, percent, miss)
    component = F.when(F.col("id").isNotNull(), F.coalesce(F.col("component.id"), F.col("id")))
    return answer.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"))


def _answers(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, miss: float) -> DataFrame:
    """(id, t, n, component) of every row.  A class of equal sets is
    represented by the smallest (id, t) of its rows, a component by the
    smallest of its classes; null where the row is in no class."""
    ship_package(docs.sparkSession)
    rows, bands = bands_for(percent / 100, miss)
    sig = written(_signatures(docs, id_col, text_col, shingle, rows, bands), "minhash-signatures")
    cls = ["f1", "f2", "n"]
    node = F.struct("id", "t")
    reps = written(
        sig.where("n > 0 and id is not null").groupBy(*cls)
        .agg(F.min(F.struct(node.alias("rep"), "keys", "bits")).alias("s"))
        .select(*cls, F.col("s.rep").alias("rep"), "s.keys", "s.bits"), "minhash-classes")
    links = _links(docs, reps, id_col, text_col, shingle, percent, max(SAMPLES, rows * bands))
    linked = reps.select(*cls, "rep").join(links, F.col("rep") == F.col("node"), "left").select(
        *cls, F.coalesce("component", "rep").alias("component"))
    return sig.select("id", "t", *cls).join(linked, cls, "left").select(
        "id", "t", "n", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """The rows of ``docs``, all columns, without those whose identifier and
    text are not their group's smallest.  Rows with a null identifier stay; rows
    that repeat both identifier and text stay or go together."""
    answer = _answers(docs, id_col, text_col, shingle, percent, miss)
    gone = answer.where(F.col("component").isNotNull() & (F.struct("id", "t") != F.col("component"))).select(
        F.col("id").alias("__gone"), F.col("t").alias("__gone_text")).distinct()
    return docs.join(gone, (F.col(id_col) == F.col("__gone")) & (F.xxhash64(text_col) == F.col("__gone_text")), "left_anti")


def _links(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str, size: int,
           percent: int, samples: int) -> DataFrame:
    """(node, component) of the representatives that link with another one."""
    spread = reps.select(F.explode("keys").alias("key"), "rep")
    shared = written(spread.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"))
                     .where("lo < hi"), "minhash-buckets")
    members = written(spread.join(shared, "key"), "minhash-members")
    wanted = members.select("rep.id", "rep.t").distinct()
    texts = written(
        _with_texts(docs, id_col, text_col).join(wanted, ["id", "t"], "left_semi").dropDuplicates(["id", "t"])
        .select(F.struct("id", "t").alias("rep"), "text"), "minhash-texts")
    bits = reps.select("rep", "bits")
    limit = sketch_limit(samples, SKETCH_BITS, percent / 100)

    def side(df: DataFrame, end: str, col: str) -> DataFrame:
        return df.toDF(end, col + end)

    def confirmed(pairs: DataFrame) -> DataFrame:
        text = texts.select("rep", "text")
        read = pairs.join(side(text, "b", "t"), "b").join(side(text, "a", "t"), "a")
        return written(_confirm(read, size, percent), "minhash-links")

    def close(pairs: DataFrame) -> DataFrame:
        differ = F.aggregate(
            F.zip_with("ba", "bb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        return (pairs.join(side(bits, "b", "b"), "b").join(side(bits, "a", "b"), "a")
                .where(differ <= limit).select("a", "b"))

    def open_buckets(nodes: DataFrame) -> DataFrame:
        """Members of the buckets that hold several components (of two
        members the one pair has been tried)."""
        named = members.select("key", "rep").join(nodes, F.col("rep") == F.col("node"), "left").select(
            "key", "rep", F.coalesce("component", "rep").alias("c"))
        # written before the join, so that Spark may split a hot bucket in it
        left = written(
            named.groupBy("key", "c").agg(F.max("rep").alias("hi"), F.count(F.lit(1)).alias("m"))
            .groupBy("key").agg(F.max("hi").alias("hi"), F.sum("m").alias("m"), F.count(F.lit(1)).alias("components"),
                                F.max(F.struct("m", "c")).alias("largest"))
            .where("components > 1 and m > 2")
            .select("key", "hi", (F.col("m") - F.col("largest.m")).alias("rest"), F.col("largest.m").alias("big"),
                    F.col("largest.c").alias("c_big")), "minhash-open-buckets")
        return written(named.join(left, "key").withColumn("inside", F.col("c") == F.col("c_big")).drop("c_big"), "minhash-open")

    tried = members.where("rep > lo").select(F.col("lo").alias("a"), F.col("rep").alias("b")).distinct()
    found = confirmed(close(tried))
    nodes = connected_components(found)
    left = open_buckets(nodes)
    if left.isEmpty():
        return nodes
    top = left.where("rep = hi").select("key", F.col("c").alias("c2"))
    second = left.join(top, "key").where("c <> c2").select(
        F.col("rep").alias("a"), F.col("hi").alias("b")).distinct()
    more = confirmed(close(second.join(tried, ["a", "b"], "left_anti")))
    if not more.isEmpty():
        found = found.unionByName(more)
        nodes = connected_components(found)
        left = open_buckets(nodes)
        if left.isEmpty():
            return nodes
    who = left.select("rep").distinct()
    fine = written(
        _fine_sketches(texts.join(who, "rep", "left_semi").select("rep", "text"), size)
        .join(reps.select("rep", "keys"), "rep"), "minhash-fine")
    last = _close_in_blocks(left.select("key", "rest", "big", "inside", "rep", "c").join(fine, "rep"),
                            sketch_limit(FINE_SAMPLES, FINE_BITS, percent / 100))
    more = confirmed(written(last, "minhash-pairs").join(tried.unionByName(second), ["a", "b"], "left_anti"))
    return nodes if more.isEmpty() else connected_components(found.unionByName(more))
