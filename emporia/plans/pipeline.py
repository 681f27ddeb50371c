"""Pipelines (L1-L4): ingest raw CSVs to Bronze Parquet (``plans.ingest``),
build Silver and Gold as path-backed catalog tables, run the declared column
tests, answer the questions.

Row counts are gathered with ``observe`` during each write (one pass per
table, no extra counting job).  A layer is published in one step
(``sources.publish``); the test step returns its report.  Paths and namespaces
are parameters; on a cluster they live in shared storage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, as_completed, wait

from pyspark.sql import DataFrame, SparkSession

from emporia.operators import quality
from emporia.plans import checks
from emporia.plans.gold import GOLD_BUILDERS, build_gold
from emporia.plans.ingest import ingest, ingest_report
from emporia.plans.layers import Layers
from emporia.plans.questions import QUESTIONS
from emporia.plans.silver import SILVER_BUILDERS, SILVER_INPUT, build_silver
from emporia.plans.silver_sql import silver_selects
from emporia.sources import catalog, files, publish
from emporia.sources.files import LAYER_OPTIONS, write_csv
from emporia.sources.observe import with_row_count
from emporia.sources.schemas import COLUMN_TESTS, SOURCE_TABLES

__all__ = ["ingest", "ingest_report", "write_tables", "build_silver_tables", "build_gold_tables", "build_layers",
           "run_pipeline", "read_layer", "LazyLayer", "layer_schemas", "references", "export_sources_csv",
           "register_layer_tables", "register_layer_views", "create_silver_views"]

#: Records of an exported file.
EXPORT_RECORDS = 2_000_000


def export_sources_csv(bronze: Mapping[str, DataFrame], raw_dir: str) -> None:
    """Write source-shaped frames as CSV directories ``<raw_dir>/<t>.csv``
    (the input format of the ingest step), gzipped."""
    for t in SOURCE_TABLES:
        write_csv(bronze[t], f"{raw_dir.rstrip('/')}/{t}.csv", compression="gzip", file_records=EXPORT_RECORDS)


def _write_counted(df: DataFrame, name: str, path: str) -> int:
    observed, obs = with_row_count(df, name)
    observed.write.options(**LAYER_OPTIONS).parquet(path)
    return int(obs.get["rows"])


def write_tables(spark: SparkSession, tables: Mapping[str, DataFrame], base: str,
                 namespace: str | None = None, parallelism: int = 4) -> dict[str, int]:
    """Write each table of a layer (and register it when a namespace is
    given), counting rows with ``observe`` in the same pass.

    All tables are written to the folder of a new build, and the layer is
    switched to it when the last one is complete.  If one fails, writes not yet
    begun are cancelled and the layer stays as it was.

    The writes are independent jobs submitted from a small thread pool, so
    small dimension jobs overlap with the large fact jobs instead of
    leaving executors idle between them.  Four threads: in a warmed
    session submitting every table at once measured faster, but in fresh
    bench runs at sf0.1 it was slower on every pipeline step."""
    base = base.rstrip("/")
    build = publish.new_build(base)
    pool = ThreadPoolExecutor(max_workers=max(1, parallelism))
    writes = {pool.submit(_write_counted, df, n, f"{base}/{build}/{n}"): n for n, df in tables.items()}
    try:
        counts = {writes[w]: w.result() for w in as_completed(writes)}
    except BaseException:
        pool.shutdown(wait=True, cancel_futures=True)
        publish.discard(spark, base, build)
        raise
    pool.shutdown()
    publish.publish(spark, base, build, list(tables))
    if namespace:
        register_layer_tables(spark, namespace, base, list(tables))
    return {name: counts[name] for name in tables}


def layer_schemas(tables: Mapping[str, DataFrame]) -> dict[str, str]:
    """Table -> schema as DDL text (part of the load report)."""
    return {name: df.schema.simpleString() for name, df in tables.items()}


def read_layer(spark: SparkSession, base: str, names) -> dict[str, DataFrame]:
    """The tables of a layer as it is published now."""
    now, base = publish.current(spark, base), base.rstrip("/")
    return {n: spark.read.parquet(now.get(n, f"{base}/{n}")) for n in names}


class LazyLayer(Mapping):
    """The tables of a written layer, each read when it is asked for: one
    that can't be read doesn't keep the others from being used."""

    def __init__(self, spark: SparkSession, base: str, names):
        self._spark, self._base, self._names = spark, base.rstrip("/"), list(names)

    def __getitem__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(publish.table_path(self._spark, self._base, name))

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def build_silver_tables(spark: SparkSession, bronze: Mapping[str, DataFrame], silver_dir: str,
                        namespace: str | None = "default_silver") -> dict[str, int]:
    """L2: Silver tables written and registered."""
    return write_tables(spark, build_silver(dict(bronze)), silver_dir, namespace)


def build_gold_tables(spark: SparkSession, silver: Mapping[str, DataFrame], gold_dir: str,
                      namespace: str | None = "default_gold") -> dict[str, int]:
    """L3: the star schema written and registered."""
    return write_tables(spark, build_gold(dict(silver)), gold_dir, namespace)


def register_layer_tables(spark: SparkSession, namespace: str, base: str, names,
                          replace: bool = True) -> list[str]:
    """Register a layer's tables, where they are published now, as external
    catalog tables ``<namespace>.<name>`` (S9 / S10): with ``replace`` each
    table is dropped and re-created over its location (files are kept),
    then refreshed.  The catalog follows table by table; every one of them is
    readable meanwhile, since the files of the layer before stay."""
    catalog.create_namespace(spark, namespace, f"{base.rstrip('/')}/_{namespace}.db")
    now, out = publish.current(spark, base), []
    for n in names:
        catalog.register_parquet(spark, f"{namespace}.{n}", now.get(n, f"{base.rstrip('/')}/{n}"), replace)
        out.append(f"{namespace}.{n}")
    return out


def register_layer_views(layer: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Register every frame of a layer as a session temp view (the view is
    the frame's lazy plan), so SQL can be run over the layer."""
    for name in layer:
        layer[name].createOrReplaceTempView(prefix + name)
    return [prefix + name for name in layer]


def create_silver_views(spark: SparkSession, namespace: str, bronze_namespace: str,
                        location: str | None = None) -> list[str]:
    """Silver as catalog views over the Bronze tables of a namespace: they
    last beyond the session and show what Bronze holds when they are read."""
    catalog.create_namespace(spark, namespace, location)
    for name, select in silver_selects(bronze_namespace).items():
        catalog.create_view(spark, f"{namespace}.{name}", select)
    return [f"{namespace}.{name}" for name in SILVER_BUILDERS]


class _Recorded(Mapping):
    """A layer that notes which of its tables are asked for."""

    def __init__(self, layer: Mapping):
        self.layer, self.asked = layer, set()

    def __getitem__(self, name: str) -> DataFrame:
        self.asked.add(name)
        return self.layer[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.layer)

    def __len__(self) -> int:
        return len(self.layer)


def references(builders: Mapping[str, Callable], inputs: Mapping[str, DataFrame]) -> dict[str, set[str]]:
    """Table -> the input tables its builder refers to, by building each plan
    over ``inputs`` (no job runs)."""
    out = {}
    for name, build in builders.items():
        layer = _Recorded(inputs)
        build(layer)
        out[name] = layer.asked
    return out


def build_layers(spark: SparkSession, bronze: Mapping[str, DataFrame], silver_dir: str, gold_dir: str,
                 silver_ns: str | None = None, gold_ns: str | None = None, parallelism: int = 4) -> dict:
    """L2, L3 and the column tests in the order of the tables' references: a
    Gold table is written as soon as the Silver tables it reads are, and a
    table is tested as soon as it is written, so that no layer waits for the
    last table of the one before.  Each layer is published when it is complete.
    Returns row counts of both layers and the failures of every test."""
    folders = {"silver": silver_dir.rstrip("/"), "gold": gold_dir.rstrip("/")}
    builds = {layer: publish.new_build(base) for layer, base in folders.items()}
    needs = references(GOLD_BUILDERS, Layers(bronze).silver)
    at = {n: f"{folders['silver']}/{builds['silver']}/{n}" for n in SILVER_BUILDERS}
    at |= {n: f"{folders['gold']}/{builds['gold']}/{n}" for n in GOLD_BUILDERS}
    counts: dict[str, int] = {}
    tests: dict[tuple[str, str, str], int] = {}

    def table(name: str) -> DataFrame:
        return spark.read.parquet(at[name])

    def write_silver(name: str) -> None:
        counts[name] = _write_counted(SILVER_BUILDERS[name](bronze), name, at[name])

    def write_gold(name: str) -> None:
        counts[name] = _write_counted(GOLD_BUILDERS[name]({n: table(n) for n in needs[name]}), name, at[name])

    def test(name: str) -> None:
        report = quality.column_test_report({name: table(name)}, {name: COLUMN_TESTS[name]})
        tests.update({(r.model_name, r.column_name, r.test_name): r.failures for r in report.collect()})

    pool = ThreadPoolExecutor(max_workers=max(1, parallelism))
    # tables that others wait for come first
    waited = {n: sum(n in need for need in needs.values()) for n in SILVER_BUILDERS}
    running = {pool.submit(write_silver, n): n for n in sorted(SILVER_BUILDERS, key=lambda n: -waited[n])}
    waiting, written = dict(needs), set()
    try:
        while running:
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(done)
                done.result()
                if name is None:  # a test
                    continue
                written.add(name)
                for n in [n for n, need in waiting.items() if need <= written]:
                    del waiting[n]
                    running[pool.submit(write_gold, n)] = n
                if name in COLUMN_TESTS:
                    running[pool.submit(test, name)] = None
                for layer, names, ns in (("silver", SILVER_BUILDERS, silver_ns), ("gold", GOLD_BUILDERS, gold_ns)):
                    if name in names and written >= set(names):
                        publish.publish(spark, folders[layer], builds[layer], list(names))
                        if ns:
                            register_layer_tables(spark, ns, folders[layer], list(names))
    except BaseException:
        pool.shutdown(wait=True, cancel_futures=True)
        for layer, names in (("silver", SILVER_BUILDERS), ("gold", GOLD_BUILDERS)):
            if not written >= set(names):
                publish.discard(spark, folders[layer], builds[layer])
        raise
    pool.shutdown()
    order = [(m, c, k) for m, columns in COLUMN_TESTS.items() for c, kinds in columns for k in kinds]
    return {"silver": {n: counts[n] for n in SILVER_BUILDERS}, "gold": {n: counts[n] for n in GOLD_BUILDERS},
            "tests": {t: tests[t] for t in order}}


def run_pipeline(spark: SparkSession, raw_dir: str, work_dir: str,
                 silver_ns: str | None = "default_silver",
                 gold_ns: str | None = "default_gold",
                 silver_as_views: bool = False,
                 stems: Mapping[str, str] | None = None, bad_share: float = 0.01) -> dict:
    """L4: ingest -> Silver -> Gold -> column tests -> questions.

    Silver is written as tables, or (``silver_as_views``) made of views over
    Bronze, the way SQL models materialise a view layer: catalog views in
    ``silver_ns``, over Bronze tables in ``<silver_ns>_bronze``, or without
    a namespace views of the session.  Gold is always written.  Returns the
    load report, the test report (collected: one small row per declared
    test), the failed tests and the lazy answers over the written Gold
    tables."""
    work = work_dir.rstrip("/")
    loads = ingest_report(spark, raw_dir, f"{work}/bronze", stems, bad_share)
    report = {"bronze": {t: x.rows for t, x in loads.items()}}
    report["set_aside"] = {t: x.bad for t, x in loads.items() if x.bad}
    report["widened"] = {t: {c: k.simpleString() for c, k in x.widened.items()} for t, x in loads.items() if x.widened}
    bronze = read_layer(spark, f"{work}/bronze", SOURCE_TABLES)
    report["bronze_schema"] = layer_schemas(bronze)
    now = publish.current(spark, f"{work}/bronze")
    report["bronze_files"] = {n: files.file_sizes(spark, now[n]) for n in SOURCE_TABLES}
    if silver_as_views:
        if silver_ns:
            bronze_ns = f"{silver_ns}_bronze"
            register_layer_tables(spark, bronze_ns, f"{work}/bronze", SOURCE_TABLES)
            create_silver_views(spark, silver_ns, bronze_ns, f"{work}/_{silver_ns}.db")
            silver = {n: spark.read.table(f"{silver_ns}.{n}") for n in SILVER_BUILDERS}
        else:
            silver = build_silver(dict(bronze))
            register_layer_views(silver)
        report["gold"] = build_gold_tables(spark, silver, f"{work}/gold", gold_ns)
        tests = checks.column_tests(silver, read_layer(spark, f"{work}/gold", GOLD_BUILDERS)).collect()
        report["tests"] = {(r.model_name, r.column_name, r.test_name): r.failures for r in tests}
    else:
        report |= build_layers(spark, bronze, f"{work}/silver", f"{work}/gold", silver_ns, gold_ns)
        # rows removed by Silver rules (dedup, purchase-time guard), per table
        report["silver_removed"] = {s: report["bronze"][b] - report["silver"][s] for s, b in SILVER_INPUT.items()}
    failed = sorted(k for k, n in report["tests"].items() if n)
    gold = read_layer(spark, f"{work}/gold", GOLD_BUILDERS)
    answers = {name: fn(gold) for name, fn in QUESTIONS.items()}
    return {"report": report, "failed_tests": failed, "answers": answers}
