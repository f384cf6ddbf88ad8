"""Every registered query of the document pipeline and its SQL twin.

The driver's tables hold no legal documents, so their texts stand in as chunks, their lines as the chunks of a document,
and orders with their items as documents with articles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..operators import articles, audit, breakage, corpus, fidelity, sft, splitter
from ..sources import jsonl
from . import planted


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts, over all cores."""
    return splitter.spread(table(spark, sf_dir, "documents"))


def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chunks, the source as link, and planted ones that every check hits some of."""
    d = documents(spark, sf_dir)
    one = F.lit(None).cast("string")
    rows = d.select(F.col("doc_id").cast("long").alias("seq"), F.col("doc_id").cast("string").alias("chunk_id"), F.col("doc_id").cast("string").alias("doc_id"), F.col("source").alias("link"), F.lit("").alias("name"), F.col("lang").alias("structure"), F.lit("").alias("dieu"), one.alias("part"), F.lit(None).cast("boolean").alias("title_confident"), F.col("text").alias("content"), F.col("n_chars").cast("long").alias("char_len"))
    return rows.unionByName(planted.planted(spark, sf_dir, planted.AUDIT_ROWS, "part"))


def bad_lines(spark: SparkSession, sf_dir: str) -> int:
    """Lines of the planted JSON lines that hold no object."""
    return planted_lines(spark, sf_dir).where(F.col("status").isin("bad_json", "not_an_object")).count()


def line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as chunks, numbered from 1."""
    d = documents(spark, sf_dir)
    return d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("_no", "content")).select("doc_id", (F.col("_no") + 1).alias("part"), "content")


def order_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents, a chapter per order and an article per item."""
    i = splitter.gather(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", "l_suppkey"), "l_orderkey")
    body = lambda s: F.concat(F.lit("Điều "), s["l_linenumber"], F.lit(". Giao hàng "), s["l_returnflag"], F.lit("\nPhương thức   giao hàng số "), s["l_partkey"], F.lit(" theo hợp đồng; bên mua "), s["l_suppkey"], F.lit(" nhận hàng."))
    items = i.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_returnflag", "l_partkey", "l_suppkey")).alias("items"))  # texts are made where the order is
    lines = F.array_sort(F.transform("items", lambda s: F.struct(s["l_linenumber"].alias("l_linenumber"), body(s).alias("t"))))
    texts = items.select("l_orderkey", F.array_join(F.transform(lines, lambda s: s["t"]), "\n").alias("t"))
    return texts.select(F.col("l_orderkey").alias("id"), F.lit("https://x/Nghi-dinh-26-2019-ND-CP").alias("link"), F.lit("").alias("name"), F.concat(F.lit("Chương I QUY ĐỊNH CHUNG\n"), "t", F.lit("\nNơi nhận: Như trên")).alias("passage"))


def audit_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.flag_chunks(document_chunks(spark, sf_dir)).select("seq", "n_chars", "n_tokens", *audit.FLAGS)


def audit_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = audit.flag_chunks(document_chunks(spark, sf_dir))
    return audit.findings(flagged, bad_lines(spark, sf_dir)).select("check", "severity", "count", "share", "place")


def audit_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.samples(audit.flag_chunks(document_chunks(spark, sf_dir))).select("check", "rank", "chunk_id", "severity", "chars", F.length("content").alias("shown"))


def audit_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.length_stats(audit.flag_chunks(document_chunks(spark, sf_dir)))


def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = audit.report(audit.flag_chunks(document_chunks(spark, sf_dir)))
    return r.select("rows_read", "chunks_scored", F.col("length.p95").alias("p95"), F.col("tokens.total").alias("total_tokens"), F.col("findings.exact_dup.count").alias("exact_dups"), "failed")


def clean_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.clean_rows(audit.flag_chunks(document_chunks(spark, sf_dir)), "train").select("seq")


def link_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.name_from_link(F.col("url")).alias("name"))


def clean_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir)
    return d.select("doc_id", F.md5(T.clean_content(T.normalize_text(F.col("text")))).alias("clean"), F.md5(T.near_key(F.col("text"))).alias("near"), F.md5(T.template_key(T.near_key(F.col("text")))).alias("template"))


def document_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sft.split_documents(table(spark, sf_dir, "documents"))


def fidelity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fidelity.fidelity_report(documents(spark, sf_dir), line_chunks(spark, sf_dir))


def document_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fidelity.document_fidelity(documents(spark, sf_dir), line_chunks(spark, sf_dir)).select("doc_id", "source_chars", "chunk_chars", "n_chunks")


def boundary_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breakage.measure_breakage(line_chunks(spark, sf_dir))


def order_article_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.extract_articles(order_articles(spark, sf_dir)).select("id", "dieu", "content", "so_dieu", "chuong", "muc", "char_len", "title_confident")


def order_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = corpus.ChunkOptions(min_chars=20)
    return corpus.chunk_documents(order_articles(spark, sf_dir), options).select("chunk_id", "doc_id", "structure", "khoan", "part", "n_parts", "char_len")


def article_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    label = F.concat(F.lit("Điền "), F.col("p_size"), F.lit(". "), F.col("p_name"))
    asked = p.select("p_partkey", F.posexplode(sft.questions(label, F.col("p_size").cast("string"), T.pretty_doc_name(F.lit("Nghi-dinh-10-2012-ND-CP")), 6)).alias("n", "question"))
    return asked.select("p_partkey", "n", "question")


def planted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.pmod("doc_id", F.lit(4))
    line = F.when(kinds == 0, F.to_json(F.struct("doc_id", "text"))).when(kinds == 1, "  ").when(kinds == 2, F.concat(F.lit("{"), F.col("text"))).otherwise(F.to_json(F.array("source")))
    lines = table(spark, sf_dir, "documents").select(line.alias("line"))
    return jsonl.parse(lines)


def json_line_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planted_lines(spark, sf_dir).groupBy("status").count().withColumnRenamed("count", "n")


def text_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document; tested against properties of the splitter."""
    d = documents(spark, sf_dir).select("doc_id", "text")
    return splitter.split_text(d).select("doc_id", F.posexplode("pieces").alias("n", "p")).select("doc_id", "n", "p.start", "p.end", "p.cut_by", F.length("p.text").alias("size"))


def training_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = corpus.chunk_documents(order_articles(spark, sf_dir), corpus.ChunkOptions(min_chars=20))
    return sft.kept(sft.build_examples(chunks)).select("doc_id", "chunk_id", "split", "kind", "user_chars")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (audit_flags, audit_findings, audit_samples, audit_lengths, audit_report, clean_training_rows, link_names, clean_texts, document_split, fidelity_report, document_fidelity, boundary_defects, order_article_rows, order_chunks, article_questions, json_line_states, text_pieces, training_examples)} | planted.queries()


# --- SQL ---------------------------------------------------------------------------------------------------------
WS = r"[\t-\r\x1c-\x20\x85\p{Z}]"


def _flags_sql() -> str:
    words = ", ".join(f"'{w}'" for w in P.COMMON_WORDS)
    plates = " OR ".join(f"contains(c, '{m}')" for m in P.BOILERPLATE)
    return rf"""
WITH base AS (
  SELECT CAST(doc_id AS BIGINT) AS seq, CAST(doc_id AS VARCHAR) AS chunk_id, coalesce(text, '') AS c, source AS link, '' AS name, n_chars AS char_len, lang AS structure, '' AS dieu, NULL AS part, NULL AS title_confident FROM documents
  UNION ALL SELECT seq, chunk_id, content, link, name, char_len, structure, dieu, part, title_confident FROM ({planted.AUDIT_ROWS})
), sized AS (
  SELECT *, length(c) AS n_chars, trim(regexp_replace(c, '{WS}+', ' ', 'g')) <> '' AS scored,
         greatest(1, CAST(round_even(length(c) / 2.4, 0) AS INT)) AS n_tokens,
         regexp_replace(lower(c), '[^\p{{L}}\p{{N}}]+', '', 'g') AS near,
         list_filter(string_split_regex(c, '{WS}+'), lambda x: x <> '') AS w
  FROM base
), keyed AS (
  SELECT *, regexp_replace(near, '\p{{Nd}}+', '0', 'g') AS template,
         list_transform(range(1, greatest(len(w) - 6, 2)), lambda i: array_to_string(w[i:i + 7], chr(1))) AS grams FROM sized
), firsts AS (
  SELECT *, min(CASE WHEN scored THEN seq END) OVER (PARTITION BY c) AS f0, min(CASE WHEN scored THEN seq END) OVER (PARTITION BY near) AS f1,
         min(CASE WHEN scored THEN seq END) OVER (PARTITION BY template) AS f2, min(seq) OVER (PARTITION BY coalesce(nullif(chunk_id, ''), 'line' || seq)) AS fc, trim(regexp_replace(coalesce(dieu, ''), '{WS}+', ' ', 'g')) = '' AS untitled FROM keyed
), flags AS (
  SELECT seq, chunk_id, c, structure, scored, n_chars, n_tokens, seq > fc AS dup_chunk_id, NOT scored AS empty_content, char_len IS DISTINCT FROM n_chars AS char_len_mismatch,
    scored AND n_tokens > 512 AS over_budget, scored AND untitled AS no_dieu, scored AND title_confident IS NOT DISTINCT FROM false AS title_guessed, scored AND coalesce(link, '') = '' AND coalesce(name, '') = '' AS no_link,
    scored AND (regexp_matches(c, '^{WS}*[);,–+-]') OR regexp_matches(regexp_extract(c, '\p{{L}}'), '^\p{{Ll}}')) AS fragment_start,
    scored AND coalesce(TRY_CAST(part AS INT), 1) > 1 AND NOT untitled AND instr(left(c, length(dieu) + 40), left(dieu, 24)) = 0 AS orphan_part, scored AND len(regexp_extract_all(c, '(?:^|[^{P.LOWER}] |[^ ])Điều{WS}+\p{{Nd}}{{1,3}}{WS}*[.:]')) >= 4 AS toc,
    scored AND n_chars < 600 AND ({plates}) AS boilerplate, scored AND n_chars < 120 AS too_short,
    scored AND seq > f0 AS exact_dup, scored AND seq = f0 AND seq > f1 AS near_dup, scored AND seq = f1 AND seq > f2 AS template_dup,
    scored AND n_chars > 80 AND len(regexp_extract_all(c, '[\p{{Nd}}.,;:/()\[\]%–—-]')) / n_chars > 0.35 AS junk_ratio,
    scored AND len(regexp_extract_all(c, '\p{{L}}')) > 40 AND len(regexp_extract_all(c, '\p{{Lu}}')) / greatest(len(regexp_extract_all(c, '\p{{L}}')), 1) > 0.75 AS all_caps,
    scored AND n_chars > 200 AND len(list_filter([{words}], lambda x: contains(lower(c), x))) < 2 AS not_vietnamese,
    scored AND len(w) >= 32 AND len(list_distinct(grams)) / len(grams) < 0.7 AS self_repeating
  FROM firsts
)"""


def _lines_sql() -> str:
    return "lines AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS part, unnest(string_split(text, chr(10))) AS content FROM documents)"


def oracle_sql() -> dict[str, str]:
    flags, lines = _flags_sql(), _lines_sql()
    names = ", ".join(audit.FLAGS)
    bad_count = "(SELECT count(*) FROM documents WHERE doc_id % 4 IN (2, 3))"
    checks = " UNION ALL ".join(f"SELECT '{n}' AS \"check\", '{s}' AS severity, {bad_count if n == 'bad_json' else f'count(*) FILTER (WHERE {n})'} AS count, count(*) FILTER (WHERE scored) AS n, {i} AS ord FROM flags" for i, (n, s, _) in enumerate(P.CHECKS))
    hit_rows = " UNION ALL ".join(f"SELECT '{n}' AS \"check\", '{s}' AS severity, seq, chunk_id, n_chars, c FROM flags WHERE {n}" for n, s, _ in P.CHECKS if n != "bad_json")
    bad = " OR ".join(n for n in (*audit.FATAL, *audit.PROFILES["train"]) if n != "bad_json")
    flat = r"regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', '', 'g')"
    source, body = flat.format("text"), flat.format("content")
    fidelity_ctes = f"""WITH {lines}, src AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, {source} AS whole FROM documents),
bodies AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, {body} AS flat FROM lines WHERE trim(content, chr(9) || chr(10) || chr(13) || ' ') <> ''),
per AS (SELECT doc_id, sum(length(flat)) AS chunk_chars, count(*) AS n_chunks FROM bodies GROUP BY doc_id),
joined AS (SELECT doc_id, length(whole) AS source_chars, chunk_chars, n_chunks, CASE WHEN length(whole) > 0 THEN chunk_chars / length(whole) END AS retention FROM src LEFT JOIN per USING (doc_id))"""
    strip = rf"regexp_replace(content, '^{WS}+|{WS}+$', '', 'g')"
    item = P.ITEM_HEAD.replace(r"\s", WS).replace(r"\d", r"\p{Nd}").replace("\\b", "")
    tail = lambda p: p.replace(r"[\w.]", r"[\p{L}\p{N}_.]").replace(r"\s", WS).replace(r"\d", r"\p{Nd}")
    defect = {
        "ends_mid_sentence": f"NOT regexp_matches(k, '[.!?;…]$') AND NOT regexp_matches(nxt, '{item}')",
        "starts_mid_sentence": r"regexp_matches(k, '^[)\];,–-]') OR regexp_matches(regexp_extract(k, '\p{L}'), '^\p{Ll}')",
        "orphan_lead_in": "k LIKE '%:'",
        "orphan_label": f"regexp_matches(k, '{tail(P.LABEL_TAIL)}')",
        "dangling_value": f"regexp_matches(k, '{tail(P.VALUE_HEAD)}')",
        "split_code": f"regexp_matches(k, '{tail(P.CODE_TAIL)}')",
        "orphan_marker": rf"regexp_matches(k, '(?:^|[.!?;]{WS})(?:\p{{Nd}}{{1,2}}\.|[a-zđư]\)){WS}*$')",
    }
    defects = ", ".join(f"k <> '' AND ({v}) AS {k}" for k, v in defect.items())
    counts = ", ".join(f"count(*) FILTER (WHERE {k}) AS {k}" for k in defect)
    article = "'Điều ' || l_linenumber || '. Giao hàng ' || l_returnflag"
    content = "'Phương thức giao hàng số ' || l_partkey || ' theo hợp đồng; bên mua ' || l_suppkey || ' nhận hàng.'"
    where = "'Điều ' || p_size || ' Nghị định 10/2012/NĐ-CP'"
    asked = [
        f"'Khoản ' || p_size || ' ' || {where} || ' quy định nội dung gì?'", f"'Cho tôi biết nội dung khoản ' || p_size || ' ' || {where} || '.'",
        f"{where} || ' quy định về vấn đề gì?'", f"'Nội dung ' || {where} || ' là gì?'",
        "'Pháp luật quy định thế nào về ' || lower(left(trim(p_name), 1)) || substr(trim(p_name), 2) || '?'", "trim(p_name) || ' được quy định ra sao trong Nghị định 10/2012/NĐ-CP?'",
    ]
    return planted.oracle_sql() | {
        "audit_flags": f"{flags} SELECT seq, n_chars, n_tokens, {names} FROM flags",
        "audit_findings": f"{flags} SELECT \"check\", severity, count, round_even(100.0 * count / greatest(n, 1), 2) AS share, row_number() OVER (ORDER BY list_position(['FATAL', 'RAG', 'TRAINING', 'INFO'], severity), count DESC, ord) AS place FROM ({checks})",
        "audit_samples": f"{flags} SELECT \"check\", rank, chunk_id, severity, n_chars AS chars, length(left(c, 400)) AS shown FROM (SELECT *, row_number() OVER (PARTITION BY \"check\" ORDER BY seq) AS rank FROM ({hit_rows})) WHERE rank <= 5",
        "audit_lengths": f"{flags} SELECT min(n_chars) AS min, quantile_disc(n_chars, 0.25) AS p25, quantile_disc(n_chars, 0.5) AS median, quantile_disc(n_chars, 0.75) AS p75, quantile_disc(n_chars, 0.95) AS p95, max(n_chars) AS max, CAST(round_even(avg(n_chars), 0) AS BIGINT) AS mean, CAST(sum(n_chars) AS BIGINT) AS total FROM flags WHERE scored",
        "audit_report": f"{flags} SELECT count(*) AS rows_read, count(*) FILTER (WHERE scored) AS chunks_scored, quantile_disc(n_chars, 0.95) FILTER (WHERE scored) AS p95, CAST(sum(n_tokens) FILTER (WHERE scored) AS BIGINT) AS total_tokens, count(*) FILTER (WHERE exact_dup) AS exact_dups, bool_or(dup_chunk_id OR empty_content OR char_len_mismatch) AS failed FROM flags",
        "clean_training_rows": f"{flags} SELECT seq FROM flags WHERE NOT ({bad})",
        "link_names": "SELECT page_id, trim(replace(regexp_replace(regexp_replace(regexp_replace(string_split(regexp_replace(url, '/+$', ''), '/')[-1], '\\.aspx$', ''), '\\.html$', ''), '\\.htm$', ''), '-', ' ')) AS name FROM pages",
        "clean_texts": rf"SELECT doc_id, md5(trim(regexp_replace(nfc_normalize(text), '{WS}+', ' ', 'g'))) AS clean, md5({source}) AS near, md5(regexp_replace({source}, '\p{{Nd}}+', '0', 'g')) AS template FROM documents",
        "document_split": "SELECT doc_id, CASE WHEN place <= floor(n * 0.9) THEN 'train' WHEN place <= floor(n * 0.9) + floor(n * 0.05) THEN 'val' ELSE 'test' END AS split FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('7' || chr(1) || doc_id), doc_id) AS place, count(*) OVER () AS n FROM (SELECT DISTINCT doc_id FROM documents))",
        "fidelity_report": f"{fidelity_ctes} SELECT * FROM (SELECT count(*) AS source_documents, count(n_chunks) AS documents_with_chunks, count(*) FILTER (WHERE n_chunks IS NULL) AS documents_with_no_chunks, round_even(median(retention), 3) AS median_character_retention, round_even(avg(retention), 3) AS mean_character_retention, count(*) FILTER (WHERE retention < 0.5) AS documents_under_50pct_retained FROM joined), (SELECT count(*) AS containment_checked, count(*) FILTER (WHERE contains(whole, flat)) AS containment_ok, count(*) FILTER (WHERE NOT contains(whole, flat)) AS containment_failed FROM bodies JOIN src USING (doc_id) WHERE flat <> '')",
        "document_fidelity": f"{fidelity_ctes} SELECT doc_id, source_chars, CAST(chunk_chars AS BIGINT) AS chunk_chars, n_chunks FROM joined",
        "boundary_defects": f"WITH {lines}, k AS (SELECT doc_id, part, {strip} AS k FROM lines), n AS (SELECT *, coalesce(lead(k) OVER (PARTITION BY doc_id ORDER BY part), '') AS nxt FROM k), f AS (SELECT doc_id, {defects} FROM n), s AS (SELECT doc_id, {counts}, count(*) AS chunks, count(*) FILTER (WHERE {' OR '.join(defect)}) AS chunks_with_defects FROM f GROUP BY doc_id) SELECT *, round_even(100.0 * chunks_with_defects / chunks, 1) AS defect_rate FROM s",
        "order_article_rows": f"SELECT l_orderkey AS id, {article} AS dieu, {content} AS content, CAST(l_linenumber AS VARCHAR) AS so_dieu, 'Chương I' AS chuong, CAST(NULL AS VARCHAR) AS muc, length({content}) AS char_len, true AS title_confident FROM lineitem",
        "order_chunks": f"SELECT l_orderkey || '_' || l_linenumber || CASE WHEN k > 1 THEN '_' || k ELSE '' END AS chunk_id, l_orderkey AS doc_id, 'dieu' AS structure, CAST(NULL AS VARCHAR) AS khoan, 1 AS part, 1 AS n_parts, length({content}) AS char_len FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {article} || chr(10) || {content}) AS k FROM lineitem)",
        "article_questions": " UNION ALL ".join(f"SELECT p_partkey, {i} AS n, {q} AS question FROM part" for i, q in enumerate(asked)),
        "json_line_states": "SELECT CASE doc_id % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'blank' WHEN 2 THEN 'bad_json' ELSE 'not_an_object' END AS status, count(*) AS n FROM documents GROUP BY 1",
    }
