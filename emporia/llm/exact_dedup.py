"""Exact dedup by a tree merge of sorted digest runs (DataFrame functions only).

Rows are dealt by a hash of their identifier into ``2**run_bits`` runs, one
partition each.  A run is sorted by digest and holds, for each text digest it
has seen, the identifier to keep and a count: that collapses a group of copies
before anything else is shuffled.  Runs are then merged in rounds.  In a round,
the ``2**fan_bits`` partitions whose addresses differ in the round's bits
exchange their entries: each of them becomes responsible for the digests whose
address has its value of those bits, and an aggregation that streams over the
sorted entries retains one per digest.  After the last round a digest's entries
have met in one run, having never had more than ``2**fan_bits`` rows to merge at
once, however large the group.  Every level is written once, as sorted runs.

Answers go back down the same tree: a run learns the verdict of each of its
digests from its parent, and a row from its run, so the rows of one hot group
are spread over all runs in every join.

Equal means equal digest, where a digest is SHA-256 verified at every level
by the text's length and an independent 64-bit hash (they are part of the
merge key, so entries that disagree are never merged).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import ascii_lower, written

KEY = ["sha", "len", "check"]


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, sha, len, check) of each row's normalised text: null counts as
    empty, A-Z are lower-cased."""
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col).alias("id"), norm.alias("norm")).select(
        "id", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"),
        F.octet_length("norm").alias("len"), F.xxhash64("norm").alias("check"))


def _slot(run_bits: int, merged_bits: int):
    """Address of the run that holds an entry after ``merged_bits`` bits:
    the low bits are the digest's, the rest still the row's."""
    low = (1 << merged_bits) - 1
    home = F.pmod(F.xxhash64("sha"), F.lit(1 << run_bits)).cast("int")
    return F.col("run").bitwiseAND(F.lit(((1 << run_bits) - 1) & ~low)).bitwiseOR(
        home.bitwiseAND(F.lit(low)))


def _merged(entries: DataFrame, keep: str, run_bits: int, level: int) -> DataFrame:
    """``entries`` (``run``, digest, ``keep``, ``n``), one per run and digest,
    as sorted runs, a partition each.

    The best identifier is that of a struct, which ranks a null last and which
    Spark aggregates over sorted rows, not in a hash table."""
    known = F.col("keep").isNotNull() if keep == "largest" else F.col("keep").isNull()
    best = F.max if keep == "largest" else F.min
    return written(
        entries.repartitionById(1 << run_bits, "run").groupBy("run", *KEY)
        .agg(best(F.struct(known.alias("known"), "keep")).alias("best"), F.sum("n").alias("n"))
        .select("run", *KEY, F.col("best.keep").alias("keep"), "n"), f"exact-level{level}")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "largest", run_bits: int | None = None, fan_bits: int = 4) -> DataFrame:
    """One row per input row: the identifier, ``keep_id``, ``group_size``,
    ``kept`` and ``text_sha256``.

    ``keep`` is 'largest' or 'smallest' identifier.  A null text is the empty
    text.  A null identifier is never kept where its group has another one.
    Rows that repeat an identifier with the same text are one document seen
    twice: both rows count in ``group_size`` and carry the same verdict.  An
    empty table gives an empty result.  Other columns are not read.
    ``run_bits`` None: as many runs as the session has shuffle partitions, or
    up to twice as many.
    """
    if run_bits is None:
        run_bits = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    rows = written(digests(docs, id_col, text_col).withColumn(
        "run", F.pmod(F.xxhash64("id"), F.lit(1 << run_bits)).cast("int")), "exact-digests")

    first = rows.select("run", *KEY, F.col("id").alias("keep"), F.lit(1).cast("long").alias("n"))
    levels = [_merged(first, keep, run_bits, 0)]
    merged_bits = 0
    while merged_bits < run_bits:
        merged_bits = min(run_bits, merged_bits + fan_bits)
        levels.append(_merged(levels[-1].withColumn("run", _slot(run_bits, merged_bits)), keep, run_bits, len(levels)))

    # verdicts walk down; a text seen once needs none
    verdict = levels[-1].where("n > 1")
    bits = [min(run_bits, k * fan_bits) for k in range(len(levels))]
    for k in range(len(levels) - 2, -1, -1):
        child = levels[k].select(F.col("run").alias("child"), *KEY,
                                 _slot(run_bits, bits[k + 1]).alias("run"))
        verdict = child.join(verdict, ["run", *KEY]).select(
            F.col("child").alias("run"), *KEY, "keep", "n")
    joined = rows.join(verdict, ["run", *KEY], "left")
    keep_id = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep"))
    return joined.select(
        F.col("id").alias(id_col), keep_id.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          keep: str = "largest") -> DataFrame:
    """The rows of ``docs``, all columns, one per distinct text.  Of rows that
    repeat the kept identifier with the same text any one stays.

    Only (digest, identifier) keys of rows that go or repeat are joined to the
    texts, and only the rows of repeated kept keys are compared again."""
    def key(sha, ident):
        return F.concat(sha, F.coalesce(F.concat(F.lit(":"), ident.cast("string")), F.lit("")))

    odd = written(
        exact_duplicates(docs, id_col, text_col, keep)
        .groupBy(key(F.col("text_sha256"), F.col(id_col)).alias("__key"))
        .agg(F.max("kept").alias("__kept"), F.count(F.lit(1)).alias("__n"))
        .where("not __kept or __n > 1").drop("__n"), "exact-odd-keys")
    sha = F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).cast("binary"), 256)
    marked = docs.withColumn("__key", key(sha, F.col(id_col)))
    out = marked.join(odd, "__key", "left_anti")
    repeated = odd.where("__kept")
    if not repeated.isEmpty():
        out = out.unionByName(marked.join(repeated, "__key", "left_semi").dropDuplicates(["__key"]))
    return out.drop("__key")


ORACLE_EXACT = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.text_sha256
FROM t JOIN g USING (text_sha256)
"""
