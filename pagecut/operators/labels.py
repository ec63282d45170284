"""Label store, label joins and expected-page checks.

The label store maps a bundle name to its first pages and page count:
``{bundle: {"target_pages": [...], "total_pages": n}}`` (legacy form:
``{bundle: [pages]}``).  It is written as JSON Lines, one object per
``(bundle, page block)``, so no record grows with the bundle and the store is
written and read in parallel; a single-object file is read as well
(``whole_file=True``).  A bundle may span several lines: readers merge them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagecut.functions.paths import page_number_from_path

# Pages per nested record.  Bounds every collect_list / array in this module.
PAGE_BLOCK = 1024

STORE_TYPE = "map<string,struct<target_pages:array<int>,total_pages:int>>"
LEGACY_TYPE = "map<string,array<int>>"
STORE_SCHEMA = T.StructType([
    T.StructField("bundle", T.StringType()),
    T.StructField("target_pages", T.ArrayType(T.IntegerType())),
    T.StructField("total_pages", T.IntegerType()),
])


def block_of(page: Column, block: int = PAGE_BLOCK) -> Column:
    return F.floor(page / F.lit(block)).cast("int")


def bundle_totals(pages: DataFrame, bundle: str, name: str = "total_pages") -> DataFrame:
    """Pages per bundle (partial aggregation: a hot bundle is pre-counted per task)."""
    return pages.groupBy(bundle).agg(F.count(F.lit(1)).cast("int").alias(name))


def target_page_lists(pages: DataFrame, bundle: str, page: str, is_first: Column,
                      block: int = PAGE_BLOCK) -> DataFrame:
    """Sorted distinct first pages per ``(bundle, block)``; blocks without any
    first page are kept with an empty list."""
    return (pages.groupBy(bundle, block_of(F.col(page), block).alias("block"))
            .agg(F.array_sort(F.collect_set(F.when(is_first, F.col(page).cast("int"))))
                 .alias("target_pages")))


def append_if_absent(arr: Column, x: Column) -> Column:
    """Add ``x`` to ``arr`` unless present (keeps the first occurrence order)."""
    return F.array_union(arr, F.array(x))


def add_target_pages(store: DataFrame, marks: DataFrame, block: int = PAGE_BLOCK) -> DataFrame:
    """Store records ``(bundle, block, target_pages)`` with the pages ``marks (bundle, page_number)`` added.

    A page that is listed already is not added twice, new ones go behind the listed ones in page
    order, and a bundle that the store lacks gets its record.  Marks are put together by
    record before the join, so a bundle that is marked often meets its record once.
    """
    new = marks.groupBy("bundle", block_of(F.col("page_number"), block).alias("block")) \
        .agg(F.array_sort(F.collect_set("page_number")).alias("__new"))
    none = F.array().cast("array<int>")
    return store.select("bundle", "block", "target_pages").join(new, ["bundle", "block"], "full_outer").select(
        "bundle", "block", F.array_union(F.coalesce("target_pages", none), F.coalesce("__new", none)).alias("target_pages"))


def build_label_store(pages: DataFrame, bundle: str, page: str, is_first: Column,
                      block: int = PAGE_BLOCK) -> DataFrame:
    """Store rows ``(bundle string, block, target_pages, total_pages)``."""
    lists = target_page_lists(pages, bundle, page, is_first, block)
    totals = bundle_totals(pages, bundle)
    return (lists.join(totals, on=bundle, how="inner")
            .select(F.col(bundle).cast("string").alias("bundle"), "block", "target_pages", "total_pages"))


def store_json(store: DataFrame) -> DataFrame:
    """One JSON object per row: ``{bundle: {target_pages, total_pages}}``."""
    return store.select(F.to_json(F.create_map(
        F.col("bundle"), F.struct("target_pages", "total_pages"))).alias("value"))


def legacy_store_json(store: DataFrame) -> DataFrame:
    return store.select(F.to_json(F.create_map(F.col("bundle"), F.col("target_pages"))).alias("value"))


def write_label_store(store: DataFrame, path: str, legacy: bool = False, mode: str = "overwrite") -> None:
    (legacy_store_json(store) if legacy else store_json(store)).write.mode(mode).text(path)


def _read_lines(spark: SparkSession, path: str, whole_file: bool) -> DataFrame | None:
    try:
        return spark.read.text(path, wholetext=whole_file)
    except AnalysisException as exc:  # a missing store is an empty store; any other failure is one
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_label_store(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """``(bundle, target_pages, total_pages)``, one row per stored fragment.

    A missing file or an unparsable line contributes nothing.  Use
    ``read_store_targets`` / ``read_store_totals`` for merged, per-page views.
    """
    raw = _read_lines(spark, path, whole_file)
    if raw is None:
        return spark.createDataFrame([], STORE_SCHEMA)
    entries = raw.select(F.explode(F.from_json("value", STORE_TYPE)).alias("bundle", "v"))
    return entries.select("bundle", F.col("v.target_pages").alias("target_pages"),
                          F.col("v.total_pages").cast("int").alias("total_pages"))


def read_store_targets(spark: SparkSession, path: str, legacy: bool = False,
                       whole_file: bool = False) -> DataFrame:
    """Exploded store: ``(bundle, page_number)``, distinct; scales with the store."""
    raw = _read_lines(spark, path, whole_file)
    if raw is None:
        return spark.createDataFrame([], "bundle string, page_number int")
    if legacy:
        e = raw.select(F.explode(F.from_json("value", LEGACY_TYPE)).alias("bundle", "pages"))
        out = e.select("bundle", F.explode("pages").alias("page_number"))
    else:
        e = raw.select(F.explode(F.from_json("value", STORE_TYPE)).alias("bundle", "v"))
        out = e.select("bundle", F.explode("v.target_pages").alias("page_number"))
    return out.distinct()


def read_store_totals(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    raw = _read_lines(spark, path, whole_file)
    if raw is None:
        return spark.createDataFrame([], "bundle string, total_pages int")
    e = raw.select(F.explode(F.from_json("value", STORE_TYPE)).alias("bundle", "v"))
    return e.groupBy("bundle").agg(F.max("v.total_pages").cast("int").alias("total_pages"))


def legacy_totals(targets: DataFrame, present_pages: DataFrame) -> DataFrame:
    """Legacy store: total pages = number of page files present per bundle."""
    counts = present_pages.groupBy("bundle").agg(F.count(F.lit(1)).cast("int").alias("total_pages"))
    return targets.select("bundle").distinct().join(counts, "bundle", "left") \
        .withColumn("total_pages", F.coalesce("total_pages", F.lit(0)))


def attach_labels(pages: DataFrame, targets: DataFrame, keys: Sequence[str] = ("bundle", "page_number"),
                  label: str = "label") -> DataFrame:
    """``label = 1`` for pages listed in ``targets``, else 0 (left join).

    No broadcast hint: the target list grows with the corpus; AQE turns the
    join into a broadcast at run time when the measured side is small.
    """
    keys = list(keys)
    t = targets.select(*keys).distinct().withColumn("__hit", F.lit(1))
    return pages.join(t, on=keys, how="left") \
        .withColumn(label, F.coalesce(F.col("__hit"), F.lit(0)).cast("int")).drop("__hit")


def write_bucketed_store(targets: DataFrame, table: str, path: str, buckets: int) -> None:
    """The label store as a table for repeated lookups: rows ``(bundle, block, target_pages)``, bucketed and
    sorted by ``(bundle, block)`` at ``path``, registered as ``table``.

    A record holds at most one block of pages, and the blocks of a bundle fall into
    buckets of their own, so a giant bundle is spread.
    """
    rows = targets.select("bundle", "page_number").distinct() \
        .groupBy("bundle", block_of(F.col("page_number")).alias("block")) \
        .agg(F.array_sort(F.collect_list("page_number")).alias("target_pages"))
    # one file a bucket
    rows.repartition(buckets, "bundle", "block").write.mode("overwrite").option("path", path) \
        .bucketBy(buckets, "bundle", "block").sortBy("bundle", "block").saveAsTable(table)


def attach_labels_bucketed(pages: DataFrame, table: str, bundle: str = "bundle", page: str = "page_number",
                           label: str = "label") -> DataFrame:
    """``attach_labels`` from a bucketed store: only the pages are shuffled, the store is read as it lies."""
    store = pages.sparkSession.table(table).withColumnRenamed("bundle", bundle)
    found = pages.withColumn("block", block_of(F.col(page))).join(store.hint("merge"), [bundle, "block"], "left")
    hit = F.coalesce(F.array_contains("target_pages", F.col(page)), F.lit(False))
    return found.withColumn(label, hit.cast("int")).drop("block", "target_pages")


def attach_labels_by_page(pages: DataFrame, targets: DataFrame, store_bundle: str, page: str = "page_number",
                          label: str = "label") -> DataFrame:
    """Labels of the one bundle ``store_bundle`` by page number, default 0: for pages without a bundle column.

    The bundle's pages are taken from the store first (the filter reaches its scan), so
    no other bundle's labels mix in; a bundle that the store lacks labels nothing.
    """
    pl = targets.where(F.col("bundle") == store_bundle).select(F.col("page_number").alias(page)).distinct().withColumn("__l", F.lit(1))
    return pages.join(pl, on=page, how="left") \
        .withColumn(label, F.coalesce(F.col("__l"), F.lit(0)).cast("int")).drop("__l")


def expected_pages(totals: DataFrame, bundle: str, total: str = "total_pages",
                   page: str = "page_number", block: int = 4096) -> DataFrame:
    """``(bundle, page)`` for pages ``0 .. total-1``; nothing when ``total <= 0``.

    Two-level generation (blocks, then pages in a block) keeps every
    generated array at most ``block`` long, whatever the bundle size.
    """
    t = totals.where(F.col(total) > 0)
    blocks = t.select(bundle, total, F.explode(F.sequence(
        F.lit(0), F.floor((F.col(total) - 1) / F.lit(block)).cast("int"))).alias("__b"))
    return blocks.select(bundle, F.explode(F.sequence(
        (F.col("__b") * F.lit(block)).cast("int"),
        (F.least(F.col(total), (F.col("__b") + 1) * F.lit(block)) - 1).cast("int"))).alias(page))


def expected_present(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.join(present.select(*keys), on=list(keys), how="left_semi")


def expected_missing(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.join(present.select(*keys), on=list(keys), how="left_anti")


def lookup_target_pages(targets: DataFrame, names: DataFrame, strict: bool = True, known: DataFrame | None = None) -> DataFrame:
    """Target pages of the requested bundles; an unknown name is an error.

    ``known`` has the bundles of the store: one that is stored without a target page has no
    row in ``targets``, but is not unknown.
    """
    if strict:
        stored = (targets if known is None else known).select("bundle").distinct()
        unknown = names.join(stored, "bundle", "left_anti").limit(1).collect()
        if unknown:
            raise KeyError(f"bundle not in label store: {unknown[0]['bundle']}")
    return targets.join(names.select("bundle").distinct(), "bundle", "left_semi")


def page_label_maps(pages: DataFrame, bundle: str, page: str, label: Column,
                    block: int = PAGE_BLOCK) -> DataFrame:
    """``map<page, label>`` per ``(bundle, block)``: bounded map records.  A page
    that stands several times gets its largest label."""
    once = pages.groupBy(bundle, F.col(page).cast("int").alias("__page")).agg(F.max(label.cast("int")).alias("__label"))
    return (once.groupBy(bundle, block_of(F.col("__page"), block).alias("block"))
            .agg(F.map_from_entries(F.collect_list(F.struct("__page", "__label"))).alias("labels")))


def map_get_default(m: Column, key: Column, default: int = 0) -> Column:
    return F.coalesce(F.try_element_at(m, key), F.lit(default))


def verify_outputs(inputs: DataFrame, produced: DataFrame, bundle: str, path: str) -> DataFrame:
    """Per input bundle: pages produced, first and last output path in page order,
    ``missing`` flag when none (``verify_written`` lists the paths)."""
    order = F.struct(page_number_from_path(F.col(path)).alias("n"), F.col(path).alias("p"))
    agg = produced.groupBy(bundle).agg(F.count(F.lit(1)).alias("n_outputs"),
                                       F.min(order)["p"].alias("first_output"),
                                       F.max(order)["p"].alias("last_output"))
    return (inputs.select(bundle).distinct().join(agg, bundle, "left")
            .withColumn("n_outputs", F.coalesce("n_outputs", F.lit(0)).cast("bigint"))
            .withColumn("missing", F.col("n_outputs") == 0))


def verify_written(expected: DataFrame, written: DataFrame, bundle: str, page: str, path: str = "name",
                   block: int = PAGE_BLOCK) -> DataFrame:
    """What a write was to produce against what it committed, one record for each ``(bundle, block)``.

    ``expected`` has ``(bundle, page)``, ``written`` the sink's commit list (``sinks.files.committed``) with
    the path of each file.  A record lists the paths in page order, the pages that lack a file and
    those written without being expected; it has at most ``block`` pages.  ``bundle_missing``: none of
    the bundle's expected pages has a file.
    """
    made = written.select(F.element_at(F.split(path, "/"), -2).alias(bundle), page_number_from_path(F.element_at(F.split(path, "/"), -1)).alias(page),
                          F.col(path).alias("path"))
    want = expected.select(F.col(bundle).cast("string").alias(bundle), F.col(page).cast("int").alias(page), F.lit(True).alias("wanted"))
    tagged = want.unionByName(made, allowMissingColumns=True).groupBy(bundle, page).agg(
        F.coalesce(F.max("wanted"), F.lit(False)).alias("wanted"), F.max("path").alias("path"))
    here = F.struct(page, "path")
    pick = lambda cond, value: F.array_sort(F.collect_list(F.when(cond, value)))
    records = tagged.groupBy(bundle, block_of(F.col(page), block).alias("block")).agg(
        F.count(F.when(F.col("wanted"), 1)).alias("n_expected"), F.count("path").alias("n_written"),
        F.transform(pick(F.col("path").isNotNull(), here), lambda s: s["path"]).alias("paths"),
        pick(F.col("wanted") & F.col("path").isNull(), F.col(page)).alias("missing_pages"),
        pick(~F.col("wanted"), F.col(page)).alias("unexpected_pages"))
    whole = records.groupBy(bundle).agg((F.sum(F.col("n_expected") - F.size("missing_pages")) == 0).alias("bundle_missing"))
    return records.join(whole, bundle)


def bundle_metadata(pages: DataFrame, bundle: str, page: str, path: Column, processed: Column,
                    block: int = PAGE_BLOCK) -> DataFrame:
    """Nested bundle records ``{pdf_name, total_pages, pages[{page_number,
    image_path}], processed_date}``, one per ``(bundle, page block)``."""
    recs = (pages.groupBy(bundle, block_of(F.col(page), block).alias("block"))
            .agg(F.array_sort(F.collect_list(F.struct(F.col(page).cast("int").alias("page_number"),
                                                      path.alias("image_path")))).alias("pages")))
    totals = bundle_totals(pages, bundle)
    return (recs.join(totals, bundle, "inner")
            .select(F.col(bundle).cast("string").alias("pdf_name"), "block", "total_pages", "pages",
                    processed.alias("processed_date")))
