"""Documents as text bundles: ``doc_id`` bundles, one line = one page;
``labels`` is the (partial) label store."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagecut.functions.paths import page_path
from pagecut.functions.udfs import SplitPages, register_is_first_page, zip_udf
from pagecut.operators import labels as L
from pagecut.operators.pages import (bundles_present, drop_null_features, pages_per_bundle,
                                     text_page_features, text_to_pages)
from pagecut.plans import standins as S
from pagecut.plans.jobs import label_pages, prepare_corpus
from pagecut.session import scratch_path
from pagecut.sinks import write_pages
from pagecut.sinks.files import write_binary_files
from pagecut.sources.bundles import read_bundles
from pagecut.sources.tables import table

PROCESSED = "2024-01-01T00:00:00"


def _targets(spark, root):
    return S.doc_label_targets(spark, root).withColumnRenamed("bundle", "doc_id")


def q_bundle_to_pages(spark, root):
    return S.document_pages(spark, root).select("doc_id", "page_number", "page_text")


def q_udtf_pages(spark, root):
    docs = table(spark, root, "documents").select("doc_id", "text")
    return SplitPages(docs.asTable()).withColumnRenamed("id", "doc_id")


def _write_bundles(spark, root):
    """Every document as an archive of its lines; every 97th archive is torn off."""
    pages = table(spark, root, "documents").select("doc_id", F.split("text", "\n").alias("pages"))
    whole = pages.select("doc_id", zip_udf()("pages").alias("content"))
    torn = F.when(F.col("doc_id") % 97 == 0, F.substring("content", 1, 40)).otherwise(F.col("content"))
    path = scratch_path(spark, "bundles")
    write_binary_files(whole.select(F.format_string("%d.zip", "doc_id").alias("name"), torn.alias("content")), "name", "content", path)
    return path


def q_binary_bundles(spark, root):
    found = read_bundles(spark, _write_bundles(spark, root), report_errors=True)
    return found.select(F.col("pdf_name").cast("bigint").alias("doc_id"), "page_number", F.octet_length("content").alias("n_bytes"),
                        F.sha2("content", 256).alias("sha256"), F.col("error").isNotNull().alias("failed"))


def q_pages_per_bundle(spark, root):
    return pages_per_bundle(S.document_pages(spark, root), "doc_id")


def q_drop_null_features(spark, root):
    p = S.document_pages(spark, root).withColumn("features", text_page_features(F.col("page_text")))
    return drop_null_features(p).select("doc_id", "page_number")


def q_bundles_present(spark, root):
    return bundles_present(S.document_pages(spark, root), "doc_id")


def q_bundle_counts(spark, root):
    """A bundle has pages if it has a text: nothing is split to count bundles."""
    lab = table(spark, root, "labels").agg(F.count_distinct("doc_id").alias("bundles_labelled"))
    proc = table(spark, root, "documents").where("text is not null").agg(F.count_distinct("doc_id").alias("bundles_processed"))
    return lab.crossJoin(proc)  # one row each


def q_attach_labels(spark, root):
    pages = S.document_pages(spark, root).select("doc_id", "page_number")
    return L.attach_labels(pages, _targets(spark, root), ["doc_id", "page_number"])


def q_unlabelled_docs(spark, root):
    docs = table(spark, root, "documents").select("doc_id")
    return docs.join(table(spark, root, "labels").select("doc_id"), "doc_id", "left_anti")


def _paths(spark, root):
    p = S.document_pages(spark, root)
    return p.withColumn("path", page_path(S.PAGE_ROOT, F.col("doc_id"), F.col("page_number")))


def q_verify_outputs(spark, root):
    inputs = table(spark, root, "labels").select("doc_id")
    return L.verify_outputs(inputs, _paths(spark, root), "doc_id", "path")


def q_bundle_metadata(spark, root):
    p = _paths(spark, root)
    meta = L.bundle_metadata(p, "doc_id", "page_number", F.col("path"), F.lit(PROCESSED))
    path = scratch_path(spark, "metadata")
    meta.select(F.to_json(F.struct("pdf_name", "total_pages", "pages", "processed_date", "block"))
                .alias("value")).write.mode("overwrite").text(path)
    schema = ("pdf_name string, total_pages int, pages array<struct<page_number:int, image_path:string>>, "
              "processed_date string, block int")
    back = spark.read.text(path).select(F.from_json("value", schema).alias("r")).select("r.*")
    return back.select("pdf_name", "block", "total_pages", F.size("pages").cast("bigint").alias("n_pages"),
                       F.col("pages")[0]["page_number"].alias("first_page"),
                       F.element_at("pages", -1)["page_number"].alias("last_page"),
                       F.col("pages")[0]["image_path"].alias("first_path"),
                       F.element_at("pages", -1)["image_path"].alias("last_path"), "processed_date")


def q_pages_partitioned(spark, root):
    docs = table(spark, root, "documents")
    pages = text_to_pages(docs, "doc_id", "text", keep=["lang"])
    path = scratch_path(spark, "pages")
    write_pages(pages, path, "doc_id", "page_number", partition_by=["lang"])
    back = spark.read.parquet(path)
    return back.select("doc_id", "page_number", "lang", F.length("page_text").cast("bigint").alias("n_chars"))


def q_job_prepare(spark, root):
    return prepare_corpus(table(spark, root, "documents"), "doc_id", "text",
                          out_path=scratch_path(spark, "prepared"))


def q_job_label(spark, root):
    pages = S.document_pages(spark, root).select("doc_id", "page_number")
    _, dist = label_pages(pages, _targets(spark, root), ["doc_id", "page_number"])
    return dist


def q_sql_registered_udf(spark, root):
    lbl = S.doc_label_targets(spark, root).withColumn("label", F.lit(1))
    register_is_first_page(spark, lbl)
    S.document_pages(spark, root).select("doc_id", "page_number").createOrReplaceTempView("pagecut_doc_pages")
    return spark.sql("SELECT doc_id, page_number, is_first_page(doc_id, page_number) AS label "
                     "FROM pagecut_doc_pages")


QUERIES = {
    "binary_bundles": q_binary_bundles,
    "bundle_to_pages": q_bundle_to_pages,
    "udtf_pages": q_udtf_pages,
    "pages_per_bundle": q_pages_per_bundle,
    "drop_null_features": q_drop_null_features,
    "bundles_present": q_bundles_present,
    "bundle_counts": q_bundle_counts,
    "attach_labels": q_attach_labels,
    "unlabelled_docs": q_unlabelled_docs,
    "verify_outputs": q_verify_outputs,
    "bundle_metadata": q_bundle_metadata,
    "pages_partitioned": q_pages_partitioned,
    "job_prepare": q_job_prepare,
    "job_label": q_job_label,
    "sql_registered_udf": q_sql_registered_udf,
}

_PAGES = """(SELECT doc_id, lang, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS page_number,
                unnest(parts) AS page_text
             FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS parts FROM documents))"""

_TARGETS = """(SELECT doc_id, 0 AS page_number FROM labels WHERE quality = 1
              UNION SELECT doc_id, 1 AS page_number FROM labels WHERE toxic = 1)"""

_ATTACH = f"""
    SELECT p.doc_id, p.page_number, CAST(CASE WHEN t.doc_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS label
    FROM {_PAGES} p LEFT JOIN {_TARGETS} t ON p.doc_id = t.doc_id AND p.page_number = t.page_number"""

_PATHS = f"""(SELECT doc_id, page_number,
                 'pages/' || CAST(doc_id AS VARCHAR) || '/page_' || CAST(page_number AS VARCHAR) || '.png' AS path
              FROM {_PAGES})"""

SQL = {
    "binary_bundles": """
        SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS page_number, CAST(strlen(unnest(parts)) AS INTEGER) AS n_bytes,
               sha256(unnest(parts)) AS sha256, false AS failed
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE doc_id % 97 <> 0)
        UNION ALL SELECT doc_id, NULL, NULL, NULL, true FROM documents WHERE doc_id % 97 = 0 AND text IS NOT NULL""",
    "bundle_to_pages": f"SELECT doc_id, page_number, page_text FROM {_PAGES}",
    "udtf_pages": f"SELECT doc_id, page_number, page_text FROM {_PAGES}",
    "pages_per_bundle": f"SELECT doc_id, count(*) AS count FROM {_PAGES} GROUP BY doc_id",
    "drop_null_features": f"SELECT doc_id, page_number FROM {_PAGES} WHERE length(page_text) >= 20",
    "bundles_present": f"SELECT DISTINCT doc_id FROM {_PAGES}",
    "bundle_counts": f"""SELECT (SELECT count(DISTINCT doc_id) FROM labels) AS bundles_labelled,
                               (SELECT count(DISTINCT doc_id) FROM {_PAGES}) AS bundles_processed""",
    "attach_labels": _ATTACH,
    "unlabelled_docs": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "verify_outputs": f"""
        SELECT i.doc_id, CAST(coalesce(o.n, 0) AS BIGINT) AS n_outputs, o.first_output, o.last_output,
               coalesce(o.n, 0) = 0 AS missing
        FROM (SELECT DISTINCT doc_id FROM labels) i
        LEFT JOIN (SELECT doc_id, count(*) AS n, arg_min(path, page_number) AS first_output,
                          arg_max(path, page_number) AS last_output
                   FROM {_PATHS} GROUP BY doc_id) o USING (doc_id)""",
    "bundle_metadata": f"""
        SELECT CAST(p.doc_id AS VARCHAR) AS pdf_name, CAST(p.page_number // 1024 AS INTEGER) AS block,
               CAST(t.total AS INTEGER) AS total_pages, count(*) AS n_pages, min(p.page_number) AS first_page,
               max(p.page_number) AS last_page, arg_min(p.path, p.page_number) AS first_path,
               arg_max(p.path, p.page_number) AS last_path, '{PROCESSED}' AS processed_date
        FROM {_PATHS} p JOIN (SELECT doc_id, count(*) AS total FROM {_PAGES} GROUP BY doc_id) t USING (doc_id)
        GROUP BY p.doc_id, p.page_number // 1024, t.total""",
    "pages_partitioned": f"SELECT doc_id, page_number, lang, length(page_text) AS n_chars FROM {_PAGES}",
    "job_prepare": f"""SELECT doc_id AS pdf_name, count(*) AS n_pages,
                              count(CASE WHEN length(page_text) >= 20 THEN 1 END) AS n_with_features
                       FROM {_PAGES} GROUP BY doc_id""",
    "job_label": f"SELECT label, count(*) AS count FROM ({_ATTACH}) GROUP BY label",
    "sql_registered_udf": _ATTACH,
}
