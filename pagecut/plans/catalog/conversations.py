"""Conversations as bundles with known segments and as the label store:
bundle ``conv_<conv_id>``, page = ``turn``, first pages = ``user`` turns."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagecut.functions.paths import basename, page_number_from_path, page_path, strip_all, strip_extension
from pagecut.operators import labels as L
from pagecut.operators.segments import segment_pages
from pagecut.plans import standins as S
from pagecut.session import scratch_path
from pagecut.sources.tables import table


def _store(spark, root):
    p = S.conversation_pages(spark, root)
    return L.build_label_store(p, "bundle", "page_number", F.col("is_first"))


def _written_store(spark, root, legacy=False):
    path = scratch_path(spark, "labelstore")
    L.write_label_store(_store(spark, root), path, legacy=legacy)
    return path


def q_label_store_roundtrip(spark, root):
    back = L.read_label_store(spark, _written_store(spark, root))
    return back.select("bundle", "total_pages", F.size("target_pages").cast("bigint").alias("n_targets"),
                       F.array_join("target_pages", ",").alias("targets"))


def q_label_store_legacy(spark, root):
    path = _written_store(spark, root, legacy=True)
    targets = L.read_store_targets(spark, path, legacy=True)
    n_targets = targets.groupBy("bundle").agg(F.count("page_number").alias("n_targets"))
    present = S.conversation_pages(spark, root).select("bundle")
    totals = L.legacy_totals(targets, present)
    return n_targets.join(totals, "bundle", "inner").select("bundle", "total_pages", "n_targets")


def q_membership(spark, root):
    pages = S.conversation_pages(spark, root).withColumn("block", L.block_of(F.col("page_number")))
    store = _store(spark, root).select("bundle", "block", "target_pages")
    j = pages.join(store, ["bundle", "block"], "left")
    return j.select("conv_id", "page_number",
                    F.coalesce(F.array_contains("target_pages", F.col("page_number")), F.lit(False))
                    .alias("is_target"))


def q_target_page_lists(spark, root):
    p = S.conversation_pages(spark, root)
    t = L.target_page_lists(p, "bundle", "page_number", F.col("is_first"))
    return t.select("bundle", "block", F.array_join("target_pages", ",").alias("targets"))


def q_attach_labels_by_page(spark, root):
    """Pages of all conversations by the label list of one of them."""
    p = S.conversation_pages(spark, root)
    targets = L.read_store_targets(spark, _written_store(spark, root))
    return L.attach_labels_by_page(p.select("conv_id", "page_number"), targets, "conv_1")


def q_attach_labels_bucketed(spark, root):
    """Labels from a store that is written bucketed and looked up without being shuffled."""
    p = S.conversation_pages(spark, root)
    path = scratch_path(spark, "bucketed-store")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    L.write_bucketed_store(L.read_store_targets(spark, _written_store(spark, root)), name, path, 8)
    return L.attach_labels_bucketed(p.select("conv_id", "bundle", "page_number"), name)


def q_add_target_pages(spark, root):
    """Every third page marked on top of the stored first pages; marks repeat, and a bundle is new."""
    p = S.conversation_pages(spark, root)
    store = L.target_page_lists(p.where("conv_id > 0"), "bundle", "page_number", F.col("is_first"))
    marks = p.where("page_number % 3 = 0").select("bundle", "page_number")
    found = L.add_target_pages(store, marks.union(marks))
    return found.select("bundle", "block", F.array_join(F.col("target_pages").cast("array<string>"), ",").alias("targets"))


def q_inline_pages(spark, root):
    p = S.conversation_pages(spark, root)
    nested = p.groupBy("bundle", L.block_of(F.col("page_number")).alias("block")).agg(
        F.collect_list(F.struct("page_number", page_path(S.PAGE_ROOT, F.col("bundle"), F.col("page_number"))
                                .alias("path"))).alias("pages"))
    return nested.selectExpr("bundle", "inline(pages)")


def q_target_pages_of(spark, root):
    p = S.conversation_pages(spark, root)
    path = _written_store(spark, root)
    names = p.select("bundle").distinct()
    return L.lookup_target_pages(L.read_store_targets(spark, path), names, known=L.read_label_store(spark, path))


def q_page_path(spark, root):
    c = table(spark, root, "conversations")
    bundle = F.concat(F.lit("conv_"), F.col("conv_id").cast("string"))
    return c.select("conv_id", "turn", page_path(S.PAGE_ROOT, bundle, F.col("turn")).alias("path"))


def q_path_parts(spark, root):
    c = table(spark, root, "conversations")
    path = F.concat(F.lit("raw/conv_"), F.col("conv_id").cast("string"), F.lit(".pdf.pdf/page_"),
                    F.col("turn").cast("string"), F.lit(".png"))
    d = c.select("conv_id", "turn", path.alias("path"))
    folder = F.element_at(F.split("path", "/"), 2)
    return d.select("conv_id", "turn", basename(F.col("path")).alias("file_name"),
                    strip_extension(folder).alias("bundle_splitext"), strip_all(folder).alias("bundle_replace"),
                    page_number_from_path(F.col("path")).alias("page_from_path"))


def q_map_lookup(spark, root):
    p = S.conversation_pages(spark, root)
    maps = L.page_label_maps(p, "bundle", "page_number", F.col("is_first"))
    totals = L.bundle_totals(p, "bundle").withColumn("probe", F.col("total_pages") + 1)
    probes = L.expected_pages(totals, "bundle", "probe").withColumn("block", L.block_of(F.col("page_number")))
    j = probes.join(maps, ["bundle", "block"], "left")
    return j.select("bundle", "page_number",
                    L.map_get_default(F.col("labels"), F.col("page_number")).alias("label"),
                    F.coalesce(F.map_contains_key("labels", F.col("page_number")), F.lit(False)).alias("has_key"))


def q_segment_rebuilds_conversation(spark, root):
    c = table(spark, root, "conversations").select("conv_id", "turn")
    seg = segment_pages(c, [], ["conv_id", "turn"], F.col("turn") == 0, number=False)
    return seg.select("conv_id", "turn", "segment_id")


QUERIES = {
    "label_store_roundtrip": q_label_store_roundtrip,
    "label_store_legacy": q_label_store_legacy,
    "membership": q_membership,
    "target_page_lists": q_target_page_lists,
    "attach_labels_by_page": q_attach_labels_by_page,
    "attach_labels_bucketed": q_attach_labels_bucketed,
    "add_target_pages": q_add_target_pages,
    "inline_pages": q_inline_pages,
    "target_pages_of": q_target_pages_of,
    "page_path": q_page_path,
    "path_parts": q_path_parts,
    "map_lookup": q_map_lookup,
    "segment_rebuilds_conversation": q_segment_rebuilds_conversation,
}

_B = "'conv_' || CAST(conv_id AS VARCHAR)"

SQL = {
    "label_store_roundtrip": f"""
        SELECT {_B} AS bundle, CAST(count(*) AS INTEGER) AS total_pages,
               CAST(count(CASE WHEN role = 'user' THEN 1 END) AS BIGINT) AS n_targets,
               coalesce(string_agg(CASE WHEN role = 'user' THEN CAST(turn AS VARCHAR) END, ',' ORDER BY turn), '')
                 AS targets
        FROM conversations GROUP BY conv_id""",
    "label_store_legacy": f"""
        SELECT {_B} AS bundle, CAST(count(*) AS INTEGER) AS total_pages,
               CAST(count(CASE WHEN role = 'user' THEN 1 END) AS BIGINT) AS n_targets
        FROM conversations GROUP BY conv_id""",
    "membership": """
        SELECT conv_id, CAST(turn AS INTEGER) AS page_number, role = 'user' AS is_target FROM conversations""",
    "target_page_lists": f"""
        SELECT {_B} AS bundle, CAST(turn // 1024 AS INTEGER) AS block,
               coalesce(string_agg(CASE WHEN role = 'user' THEN CAST(turn AS VARCHAR) END, ',' ORDER BY turn), '')
                 AS targets
        FROM conversations GROUP BY conv_id, turn // 1024""",
    "attach_labels_by_page": """
        SELECT conv_id, CAST(turn AS INTEGER) AS page_number,
               CAST(turn IN (SELECT turn FROM conversations WHERE conv_id = 1 AND role = 'user') AS INTEGER) AS label
        FROM conversations""",
    "attach_labels_bucketed": f"""
        SELECT conv_id, {_B} AS bundle, CAST(turn AS INTEGER) AS page_number, CAST(role = 'user' AS INTEGER) AS label
        FROM conversations""",
    "add_target_pages": f"""
        SELECT {_B} AS bundle, CAST(turn // 1024 AS INTEGER) AS block,
               concat_ws(',', nullif(string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) FILTER (role = 'user' AND conv_id > 0), ''),
                              nullif(string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn)
                                     FILTER (turn % 3 = 0 AND NOT (role = 'user' AND conv_id > 0)), '')) AS targets
        FROM conversations GROUP BY conv_id, turn // 1024 HAVING conv_id > 0 OR count(*) FILTER (turn % 3 = 0) > 0""",
    "inline_pages": f"""
        SELECT {_B} AS bundle, CAST(turn AS INTEGER) AS page_number,
               'pages/' || {_B} || '/page_' || CAST(turn AS VARCHAR) || '.png' AS path
        FROM conversations""",
    "target_pages_of": f"""
        SELECT DISTINCT {_B} AS bundle, CAST(turn AS INTEGER) AS page_number FROM conversations
        WHERE role = 'user'""",
    "page_path": f"""
        SELECT conv_id, turn, 'pages/' || {_B} || '/page_' || CAST(turn AS VARCHAR) || '.png' AS path
        FROM conversations""",
    "path_parts": """
        SELECT conv_id, turn, string_split(path, '/')[-1] AS file_name,
               regexp_replace(string_split(path, '/')[2], '\\.[^./]+$', '') AS bundle_splitext,
               replace(string_split(path, '/')[2], '.pdf', '') AS bundle_replace,
               CAST(string_split(string_split(path, '_')[-1], '.')[1] AS INTEGER) AS page_from_path
        FROM (SELECT conv_id, turn,
                     'raw/conv_' || CAST(conv_id AS VARCHAR) || '.pdf.pdf/page_' || CAST(turn AS VARCHAR) || '.png'
                       AS path FROM conversations)""",
    "map_lookup": f"""
        WITH t AS (SELECT conv_id, count(*) AS total FROM conversations GROUP BY conv_id),
        probes AS (SELECT conv_id, CAST(unnest(range(0, total + 1)) AS INTEGER) AS page_number FROM t)
        SELECT 'conv_' || CAST(p.conv_id AS VARCHAR) AS bundle, p.page_number,
               CAST(coalesce(CASE WHEN c.role = 'user' THEN 1 ELSE 0 END, 0) AS INTEGER) AS label,
               c.conv_id IS NOT NULL AS has_key
        FROM probes p LEFT JOIN conversations c ON c.conv_id = p.conv_id AND c.turn = p.page_number""",
    "segment_rebuilds_conversation": """
        SELECT conv_id, turn, CAST(sum(CASE WHEN turn = 0 THEN 1 ELSE 0 END)
               OVER (ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER)
               AS segment_id
        FROM conversations""",
}
