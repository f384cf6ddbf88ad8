"""Queries over planted legal documents, and their SQL twins.

The driver's tables hold no legal text, so documents with known structure are written from their rows. Their texts are SQL
that both engines read, so a query and its twin see the same input; what comes out is computed by the operators on one
side and from the known structure, or by another method, on the other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..operators import articles, breakage, corpus, sft, splitter

NL = "\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def planted(spark: SparkSession, sf_dir: str, sql: str, source: str) -> DataFrame:
    """The rows of a query in the common part of both dialects over one table."""
    return spark.sql(sql.replace(f"FROM {source}", f"FROM {{{source}}}"), **{source: splitter.spread(table(spark, sf_dir, source))})


# --- chunks for the audit ------------------------------------------------------------------------------------------
_BODY = "'Cơ quan nhà nước thực hiện quy định của pháp luật về ' || p_name || ' số ' || CAST(p_partkey AS STRING) || ' theo khoản này và các điều khác trong năm; việc thực hiện được cơ quan có thẩm quyền kiểm tra.'"
_AUDIT = {
    2: "'   '", 7: f"'Điều 7. Tiêu đề của điều — ' || {_BODY}", 8: "'MỤC LỤC Điều 1. A Điều 2. B Điều 3. C tại Điều 9. Điều 4. D ' || p_name || repeat(' CHƯƠNG MỤC', 12)",
    9: "'Nơi nhận: Như trên; Lưu: VT, ' || CAST(p_partkey AS STRING)", 10: f"'Nội dung giống nhau của cơ quan nhà nước' || repeat('!', CAST(p_partkey % 7 AS INT)) || ' {'quy định này được thực hiện theo khoản một; ' * 3}'",
    11: "'Mẫu báo cáo số ' || CAST(p_partkey AS STRING) || ' của cơ quan thực hiện theo quy định; ' || repeat('nơi nhận báo cáo là các đơn vị liên quan ', 1) || 'và được lập mỗi năm một lần theo mẫu này.'",
    12: "repeat('1.2;', 30) || CAST(p_partkey AS STRING)", 13: "'CƠ QUAN THỰC HIỆN THEO QUY ĐỊNH CỦA PHÁP LUẬT ' || upper(p_name) || repeat(' TRONG NĂM NÀY', 6)",
    14: "repeat('nội dung lặp lại của cơ quan ', 30) || CAST(p_partkey AS STRING)", 15: f"') và tiếp tục; ' || {_BODY}",
}
_KIND = "p_partkey % 16"
_CONTENT = f"CASE {_KIND} {' '.join(f'WHEN {k} THEN {v}' for k, v in _AUDIT.items())} ELSE {_BODY} END"
AUDIT_ROWS = f"""SELECT CAST(100000000 + p_partkey AS BIGINT) AS seq, CASE WHEN {_KIND} = 1 THEN 'dup' || CAST(p_partkey % 48 AS STRING) ELSE 'p' || CAST(p_partkey AS STRING) END AS chunk_id,
  'p' || CAST(p_partkey AS STRING) AS doc_id, CASE WHEN {_KIND} = 5 THEN '' ELSE 'link' END AS link, CASE WHEN {_KIND} = 4 THEN 'tên' ELSE '' END AS name, 'dieu' AS structure,
  CASE WHEN {_KIND} IN (6, 7) THEN 'Điều 7. Tiêu đề của điều' WHEN {_KIND} = 3 THEN ' ' ELSE 'Điều 5. Tên' END AS dieu, CASE WHEN {_KIND} IN (6, 7) THEN '2' WHEN {_KIND} = 15 THEN 'x' ELSE '1' END AS part,
  {_KIND} <> 4 AS title_confident, {_CONTENT} AS content, CAST(length({_CONTENT}) + CASE WHEN {_KIND} = 3 THEN 1 ELSE 0 END AS BIGINT) AS char_len FROM part"""

# --- articles with context -----------------------------------------------------------------------------------------
ARTICLE_DOCS = f"""SELECT c_custkey AS id, 'Mở đầu theo Điều 9. thì bỏ.{NL}Chương I QUY ĐỊNH CHUNG{NL}Mục 1. PHẠM VI{NL}Điều 1. Tên một{NL}Nội dung   một của ' || c_name || ' theo Điều 3. này.{NL}Mục 2. ĐỐI TƯỢNG{NL}Chương II TỔ CHỨC{NL}'
  || 'Ðiều 2a: Tên hai Nghị định này áp dụng cho ' || c_name || '.{NL}Điền 3. Công bố theo Luật này 1. Hồ sơ gồm ' || CAST(c_custkey AS STRING) || ' tờ.{NL}ĐIỀU 4. Không rõ ' || CAST(c_custkey AS STRING) || ' việc'
  || '{NL}Mục 1. A B' || repeat('{NL}Chương IV CHUNG', 13) || '{NL}Điều 5. Hiệu lực{NL}Có hiệu lực từ ngày ký. –/; Nơi nhận: ' || c_name || '{NL}Điều 6.{NL}' AS passage FROM customer"""
_EXPECTED_ARTICLES = (
    ("'Điều 1. Tên một'", "'Nội dung một của ' || c_name || ' theo Điều 3. này.'", "1", "Chương I", "Mục 1.", True),
    ("'Ðiều 2a: Tên hai'", "'Nghị định này áp dụng cho ' || c_name || '.'", "2a", "Chương II", "Mục 2.", False),
    ("'Điền 3. Công bố theo Luật này'", "'1. Hồ sơ gồm ' || c_custkey || ' tờ.'", "3", "Chương II", "Mục 2.", False),
    ("'ĐIỀU 4.'", "'Không rõ ' || c_custkey || ' việc'", "4", "Chương II", "Mục 2.", False),
    ("'Điều 5. Hiệu lực'", "'Có hiệu lực từ ngày ký.'", "5", "Chương IV", "Mục 1.", True),
)

# --- clauses, points and documents without articles ----------------------------------------------------------------
MOST, LEAST = 400, 100
_CLAUSES = range(1, 9)
_N = "(3 + c_custkey % 6)"
_tail = lambda i, m: f"repeat(' thực hiện nghĩa vụ theo quy định', CAST((c_custkey * {i}) % {m} + 1 AS INT)) || '.'"
_POINTED = "c_custkey % 3 = 0"
_points = {p: f"'{p}) Điểm của ' || c_name || {_tail(k + 2, 6)}" for k, p in enumerate("abcdđe")}
_LEAD = "'Các nghĩa vụ từ điểm 18. Tọa độ của ' || c_name || ' như sau:'"


def _clause(i: int) -> str:
    plain = f"'{i}. Nội dung khoản ' || c_name || {_tail(i, 9)}"
    return f"CASE WHEN {_POINTED} THEN '3. Gồm có:' || {' || '.join(f"' ' || {t}" for t in _points.values())} ELSE {plain} END" if i == 3 else plain


_ARTICLE = f"{_LEAD} || {' || '.join(f"CASE WHEN {_N} >= {i} THEN ' ' || {_clause(i)} ELSE '' END" for i in _CLAUSES)}"
CLAUSE_DOCS = f"""SELECT c_custkey AS id, c_mktsegment AS segment, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN 'Thông báo   của ' || c_name || ' không có điều nào.{NL}'
  ELSE 'Điều 1. Nghĩa vụ{NL}' || {_ARTICLE} END AS passage FROM customer"""


def _clause_oracle() -> str:
    """Segments from the known structure, packed by a recursive walk; the stub of the end joins the chunk before."""
    segs = [f"SELECT c_custkey AS id, 0 AS k, CAST(NULL AS VARCHAR) AS label, {_LEAD} AS t FROM docs"]
    for i in _CLAUSES:
        if i != 3:
            segs.append(f"SELECT c_custkey, {i * 10}, '{i}', {_clause(i)} FROM docs WHERE {_N} >= {i}")
            continue
        segs.append(f"SELECT c_custkey, 30, '3', CASE WHEN {_POINTED} AND length({_clause(3)}) > {MOST} THEN '3. Gồm có:' ELSE {_clause(3)} END FROM docs")
        segs += [f"SELECT c_custkey, {31 + n}, '3{p}', {t} FROM docs WHERE {_POINTED} AND length({_clause(3)}) > {MOST}" for n, (p, t) in enumerate(_points.items())]
    return f"""WITH RECURSIVE docs AS (SELECT * FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 5 <> 0),
whole AS (SELECT c_custkey AS id, {_ARTICLE} AS t FROM docs),
segs AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k) AS n FROM ({' UNION ALL '.join(segs)})),
walk AS (
  SELECT id, n, 1 AS chunk, t AS buf, label AS a, label AS z FROM segs WHERE n = 1
  UNION ALL
  SELECT w.id, s.n, w.chunk + CASE WHEN length(w.buf) + 1 + length(s.t) > {MOST} THEN 1 ELSE 0 END,
    CASE WHEN length(w.buf) + 1 + length(s.t) > {MOST} THEN s.t ELSE w.buf || ' ' || s.t END,
    CASE WHEN length(w.buf) + 1 + length(s.t) > {MOST} THEN s.label ELSE coalesce(w.a, s.label) END,
    CASE WHEN length(w.buf) + 1 + length(s.t) > {MOST} THEN s.label ELSE coalesce(s.label, w.z) END
  FROM walk w JOIN segs s ON s.id = w.id AND s.n = w.n + 1),
packed AS (SELECT id, chunk, arg_max(buf, n) AS buf, arg_max(a, CASE WHEN a IS NOT NULL THEN n END) AS a, arg_max(z, CASE WHEN z IS NOT NULL THEN n END) AS z FROM walk GROUP BY id, chunk),
ends AS (SELECT *, max(chunk) OVER (PARTITION BY id) AS n, lead(buf) OVER (PARTITION BY id ORDER BY chunk) AS nb, lead(a) OVER (PARTITION BY id ORDER BY chunk) AS na, lead(z) OVER (PARTITION BY id ORDER BY chunk) AS nz,
  lag(buf) OVER (PARTITION BY id ORDER BY chunk) AS pb FROM packed),
joined AS (SELECT id, chunk, CASE WHEN chunk = n - 1 AND length(nb) < {LEAST} AND length(buf) + 1 + length(nb) <= {MOST} THEN buf || ' ' || nb ELSE buf END AS buf,
  CASE WHEN chunk = n - 1 AND length(nb) < {LEAST} AND length(buf) + 1 + length(nb) <= {MOST} THEN coalesce(a, na) ELSE a END AS a, CASE WHEN chunk = n - 1 AND length(nb) < {LEAST} AND length(buf) + 1 + length(nb) <= {MOST} THEN coalesce(nz, z) ELSE z END AS z
  FROM ends WHERE NOT (n > 1 AND chunk = n AND length(buf) < {LEAST} AND length(pb) + 1 + length(buf) <= {MOST})),
pieces AS (SELECT j.id, CASE WHEN a = z THEN a ELSE a || '–' || z END AS khoan, chunk AS part, count(*) OVER (PARTITION BY j.id) AS n_parts, buf AS content FROM joined j JOIN whole w ON w.id = j.id WHERE length(w.t) > {MOST}
  UNION ALL SELECT id, NULL, 1, 1, t FROM whole WHERE length(t) <= {MOST}),
chunks AS (SELECT id || '_1' || CASE WHEN n_parts > 1 THEN '_p' || part ELSE '' END AS chunk_id, id AS doc_id, 'dieu' AS structure, khoan, part, n_parts, content FROM pieces
  UNION ALL SELECT c_custkey || '_1', c_custkey, 'plain', NULL, 1, 1, 'Thông báo của ' || c_name || ' không có điều nào.' FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 5 = 0)"""


# --- boundaries ------------------------------------------------------------------------------------------------------
SIZE, FILL = 400, 220
_UNITS = range(1, 15)
_M = "(9 + c_custkey % 6)"
_unit = lambda i: f"'Câu số {i} của ' || c_name || repeat(' nói rõ', CAST((c_custkey * {i * i + 1}) % 12 AS INT))"
_sep = lambda i: f"CASE (c_custkey + {i * i}) % 5 WHEN 0 THEN '.{NL}{NL}' WHEN 1 THEN '.{NL}' WHEN 2 THEN '; ' ELSE '. ' END"
BOUNDARY_DOCS = f"""SELECT c_custkey AS doc_id, {' || '.join(f"CASE WHEN {_M} > {i} THEN {_unit(i)} || {_sep(i)} WHEN {_M} = {i} THEN {_unit(i)} || '.' ELSE '' END" for i in _UNITS)} AS text FROM customer"""


def _boundary_oracle() -> str:
    """Places and levels of the known separators; a recursive walk takes the furthest of the strongest in reach."""
    levels = [name for name, *_ in P.LEVELS]
    units = " UNION ALL ".join(f"SELECT c_custkey AS id, {i} AS i, {_unit(i)} AS u, CASE WHEN {_M} = {i} THEN '.' ELSE {_sep(i)} END AS s, {_M} = {i} AS last FROM customer WHERE {_M} >= {i}" for i in _UNITS)
    at = f"CASE WHEN s = '.{NL}{NL}' THEN {levels.index('paragraph')} WHEN s = '.{NL}' THEN {levels.index('line')} WHEN s = '; ' THEN {levels.index('clause')} ELSE {levels.index('sentence')} END"
    return f"""WITH RECURSIVE units AS ({units}), ends AS (SELECT *, CAST(sum(length(u) + length(s)) OVER (PARTITION BY id ORDER BY i) AS INT) AS pos FROM units),
cuts AS (SELECT id, pos, {at} AS level FROM ends WHERE NOT last UNION ALL SELECT id, pos - 1, {levels.index('line')} FROM ends WHERE s = '.{NL}{NL}'),
texts AS (SELECT id, max(pos) AS n FROM ends GROUP BY id),
walk AS (SELECT id, 0 AS a, 0 AS z, 0 AS level, n, 0 AS k FROM texts
  UNION ALL
  SELECT w.id, w.z, CASE WHEN w.n - w.z <= {SIZE} THEN w.n ELSE b.pos END, CASE WHEN w.n - w.z <= {SIZE} THEN -1 ELSE b.level END, w.n, w.k + 1
  FROM walk w LEFT JOIN LATERAL (SELECT c.pos, c.level FROM cuts c WHERE c.id = w.id AND c.pos > w.z AND c.pos <= w.z + {SIZE}
    ORDER BY CASE WHEN c.pos >= w.z + {FILL} THEN 0 ELSE 1 END, c.level, c.pos DESC LIMIT 1) b ON true
  WHERE w.z < w.n)
SELECT id AS doc_id, k - 1 AS n, a AS start, z AS "end", CASE level WHEN -1 THEN CASE WHEN n <= {SIZE} THEN 'whole' ELSE 'end' END {' '.join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(levels))} END AS cut_by FROM walk WHERE k > 0"""


SPAN_DOCS = f"""SELECT p_partkey AS doc_id, CASE p_partkey % 3 WHEN 0 THEN 'Theo Thông tư ' || CAST(p_size AS STRING) || '/2010/TT-BTC ngày 10/12/2010 mức ' || CAST(p_size AS STRING) || ',5 mg/kg'
  WHEN 1 THEN 'Mở đầu. P = ' || CAST(p_size AS STRING) || ',5 x k. Hết.' ELSE 'Mục B.' || CAST(p_size AS STRING) || '.2 và [1] tài liệu; [2] sách {NL}hết' END AS text FROM part"""
SENTENCE_DOCS = "SELECT p_partkey AS doc_id, 'Ông TS. Nam và Bà B. Lan mua ' || p_name || '. Theo mục 1.' || repeat(' ', CAST(p_size * 3 + 1 AS INT)) || '2 thì thôi! \"Đúng\" không? v.v. Hết' AS text FROM part"
NORMAL_DOCS = "SELECT p_partkey AS doc_id, p_name || 'é' || '\r\nd​ội ' || '﻿‪' || p_brand || '\r' || 'ÅÅ' AS text FROM part"
BREAK_DOCS = "SELECT p_partkey AS doc_id, 'Mở đầu. P = ' || CAST(p_size AS STRING) || ' x k. Hết.' AS text FROM part"
BREAK_CHUNKS = "SELECT p_partkey AS doc_id, CASE WHEN p_partkey % 2 = 0 THEN 'Mở đầu.' ELSE 'Mở đầu. P = ' || CAST(p_size AS STRING) END AS first, CASE WHEN p_partkey % 2 = 0 THEN 'P = ' || CAST(p_size AS STRING) || ' x k. Hết.' ELSE 'x k. Hết.' END AS second FROM part"

# --- training examples -----------------------------------------------------------------------------------------------
VALIDATED = f"SELECT p_partkey AS id, 'Có ' || CAST(p_size AS STRING) || ' mục, 2,5%. Điều ' || CAST(p_partkey % 9 AS STRING) AS u, CASE p_partkey % 11 WHEN 0 THEN ' ' WHEN 1 THEN '{P.REFUSAL}' ELSE 'Gồm ' || CAST(p_partkey % 60 AS STRING) || ' mục, 2,5%{NL}{NL}(Căn cứ: Điều ' || CAST(p_partkey % 7 AS STRING) || ')' END AS a FROM part"
ANSWERED = f"SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split, CASE WHEN p_partkey % 10 = 0 THEN 'refusal' ELSE 'grounded' END AS kind, CASE WHEN p_partkey % 10 = 0 THEN '{P.REFUSAL}' WHEN p_partkey % 17 = 0 THEN '...' ELSE 'Trả lời: ' || p_brand || repeat('!', CAST(p_partkey % 3 AS INT)) END AS assistant, p_partkey % 13 = 0 AS bad FROM part"
NAMES = tuple((f"{prefix}-{{n}}-2019-ND-CP", f"{label} {{n}}/2019/NĐ-CP") for prefix, label in P.DOCUMENT_KINDS) + tuple((f"{prefix}-ve-viec-{{n}}", f"{label} ve viec {{n}}") for prefix, label in P.DOCUMENT_KINDS) + (("Luật Đất đai {n}", "Luật Đất đai {n}"), ("so-{n}-khac", "so {n} khac"))
_nth = lambda side: "CASE p_partkey % 28 " + " ".join(f"WHEN {k} THEN '{x[side].replace('{n}', chr(39) + ' || CAST(p_partkey AS STRING) || ' + chr(39))}'" for k, x in enumerate(NAMES)) + " END"


def context_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.extract_articles(planted(spark, sf_dir, ARTICLE_DOCS, "customer")).select("id", "dieu", "content", "so_dieu", "chuong", "muc", "char_len", "title_confident")


OPTIONS = corpus.ChunkOptions(max_chars=MOST, min_chunk_chars=LEAST, min_chars=20)


def clause_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = corpus.chunk_documents(planted(spark, sf_dir, CLAUSE_DOCS, "customer"), OPTIONS)
    return got.select("chunk_id", "doc_id", "structure", "khoan", "part", "n_parts", "content", "char_len")


def corpus_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = corpus.summary(planted(spark, sf_dir, CLAUSE_DOCS, "customer"), OPTIONS)
    return s.select("*", F.col("by_structure.dieu").alias("dieu_chunks"), F.col("by_structure.plain").alias("plain_chunks")).drop("by_structure", "duplicates_dropped")


def boundary_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = splitter.split_text(planted(spark, sf_dir, BOUNDARY_DOCS, "customer"), max_chars=SIZE, min_chars=0, protect=False)
    return got.select("doc_id", F.posexplode("pieces").alias("n", "p")).select("doc_id", "n", "p.start", "p.end", "p.cut_by")


def protected_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitter.span_rows(planted(spark, sf_dir, SPAN_DOCS, "part"), "doc_id")


def prose_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planted(spark, sf_dir, SENTENCE_DOCS, "part").select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("n", "sentence"))


def normalized_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planted(spark, sf_dir, NORMAL_DOCS, "part").select("doc_id", T.normalize_text(F.col("text")).alias("normal"), T.near_key(T.normalize_text(F.col("text"))).alias("near"))


def atomic_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = planted(spark, sf_dir, BREAK_CHUNKS, "part").select("doc_id", F.posexplode(F.array("first", "second")).alias("part", "content"))
    got = breakage.count_atomic_breaks(planted(spark, sf_dir, BREAK_DOCS, "part"), parts)
    return got.select("doc_id", "atomic_blocks", "atomic_broken", F.array_join("broken_kinds", ",").alias("kinds"), F.array_join("examples", "|").alias("examples"))


def similar_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = "SELECT CAST(floor(vec_id / 10) AS BIGINT) AS doc, vec_id AS n, repeat('x', CAST(vec_id % 7 + 1 AS INT)) AS t, embedding AS v FROM embeddings"
    return splitter.merge_similar(planted(spark, sf_dir, sql, "embeddings"), "doc", "n", "t", "v", max_chars=12, threshold=0.05).withColumn("content", F.length("content"))


def example_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planted(spark, sf_dir, VALIDATED, "part").select("id", F.array_join(sft.problems(F.col("u"), F.col("a")), ";").alias("problems"))


def answer_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = planted(spark, sf_dir, ANSWERED, "part").withColumn("_order", F.md5(F.col("id").cast("string")))
    rows = rows.withColumn("problems", F.when(F.col("bad"), F.array(F.lit("empty_answer"))).otherwise(F.array().cast("array<string>")))
    strict = sft.mark_leaks(rows, strict=True).select("id", F.col("leak").alias("strict_leak"))
    return sft.mark_leaks(rows).select("id", "split", "kind", "leak").join(strict, "id")


def refusal_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", (sft.draw(7, F.col("o_orderkey"), F.lit(0)) < 0.12).alias("refuse"))


def cited_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = f"SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN {_nth(0)} ELSE '' END AS name, 'https://x.example/a/' || {_nth(0)} || '-99.aspx' AS link FROM part"
    return planted(spark, sf_dir, sql, "part").select("id", T.pretty_doc_name(F.col("name"), F.col("link")).alias("cited"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (context_articles, clause_chunks, corpus_summary, boundary_pieces, protected_tokens, prose_sentences, normalized_texts, atomic_breaks, similar_pieces, example_problems, answer_leaks, refusal_draws, cited_names)}


def oracle_sql() -> dict[str, str]:
    near = r"regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', '', 'g')"
    normal = "regexp_replace(replace(replace(replace(nfc_normalize(text), '\r\n', '\n'), '\r', '\n'), ' ', ' '), '[﻿​‌‍‎‏‪‫‬‭‮]', '', 'g')"
    size = "CAST(p_size AS VARCHAR)"
    code = f"'Theo Thông tư ' || {size} || '/2010/TT-BTC'"
    token = lambda where, a, b, kind="token": f"SELECT p_partkey AS doc_id, CAST({a} AS INT) AS start, CAST({b} AS INT) AS \"end\", '{kind}' AS kind FROM part WHERE p_partkey % 3 = {where}"
    spans = [
        token(0, "length('Theo Thông tư ')", f"length({code})"), token(0, f"length({code} || ' ngày ')", f"length({code} || ' ngày 10/12/2010')"),
        token(0, f"length({code} || ' ngày 10/12/2010 mức ')", f"length({code} || ' ngày 10/12/2010 mức ' || {size} || ',5 mg/kg')"),
        token(1, "length('Mở đầu.')", f"length('Mở đầu. P = ' || {size} || ',5 x k.')", "formula+token"),
        token(2, "length('Mục ')", f"length('Mục B.' || {size} || '.2')", "token"),
        token(2, f"length('Mục B.' || {size} || '.2 và ')", f"length('Mục B.' || {size} || '.2 và [1] tài liệu; [2] sách ')", "refs"),
    ]
    answer = near.format("assistant")
    numbers = lambda c: rf"regexp_extract_all({c}, '\d+(?:[.,]\d+)?%?')"
    stray = f"list_filter({numbers('a')}, lambda x: NOT list_contains({numbers('u')}, x))[1:5]"
    cited = r"regexp_extract(a, 'Căn cứ:\s*Điều\s+(\d{1,3}[a-zđ]?)', 1)"
    clauses = _clause_oracle()
    return {
        "context_articles": " UNION ALL ".join(f"SELECT c_custkey AS id, {d} AS dieu, {c} AS content, '{n}' AS so_dieu, '{ch}' AS chuong, '{m}' AS muc, length({c}) AS char_len, {str(sure).lower()} AS title_confident FROM customer" for d, c, n, ch, m, sure in _EXPECTED_ARTICLES),
        "clause_chunks": f"{clauses} SELECT *, length(content) AS char_len FROM chunks",
        "corpus_summary": f"""{clauses}, firsts AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, part) AS k FROM chunks)
SELECT (SELECT count(*) FROM customer) AS documents_read, count(*) AS chunks_written, round_even(count(*) / (SELECT count(*) FROM customer), 2) AS chunks_per_document, CAST(round_even(avg(length(content)), 0) AS BIGINT) AS mean_chunk_chars,
  count(*) FILTER (WHERE structure = 'dieu') AS dieu_chunks, count(*) FILTER (WHERE structure = 'plain') AS plain_chunks, (SELECT count(*) FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 5 = 0) AS documents_without_dieu,
  0 AS documents_skipped, count(*) FILTER (WHERE length(content) > {MOST}) AS chunks_over_budget, CAST(round_even(avg(length(content)) FILTER (WHERE length(content) > {MOST}), 0) AS BIGINT) AS mean_over_budget_chars,
  0 AS documents_timed_out, 0 AS documents_producing_nothing, (SELECT count(*) FROM customer WHERE c_custkey % 7 = 0) AS empty_text, 0 AS chunks_too_short, count(*) FILTER (WHERE k > 1) AS duplicate_chunks FROM firsts""",
        "boundary_pieces": _boundary_oracle(),
        "protected_tokens": " UNION ALL ".join(spans),
        "prose_sentences": " UNION ALL ".join(f"SELECT p_partkey AS doc_id, {i} AS n, {s} AS sentence FROM part" for i, s in enumerate(("'Ông TS. Nam và Bà B. Lan mua ' || p_name || '.'", "'Theo mục 1.' || repeat(' ', p_size * 3 + 1) || '2 thì thôi!'", "'\"Đúng\" không? v.v. Hết'"))),
        "normalized_texts": f"SELECT doc_id, {normal} AS normal, {near.format(normal)} AS near FROM ({NORMAL_DOCS})",
        "atomic_breaks": f"SELECT p_partkey AS doc_id, 1 AS atomic_blocks, p_partkey % 2 AS atomic_broken, CASE WHEN p_partkey % 2 = 1 THEN 'formula' ELSE '' END AS kinds, CASE WHEN p_partkey % 2 = 1 THEN ' P = ' || {size} || ' x k.' ELSE '' END AS examples FROM part",
        "similar_pieces": """WITH RECURSIVE p AS (SELECT CAST(floor(vec_id / 10) AS BIGINT) AS doc, vec_id % 7 + 1 AS len, row_number() OVER w AS n, coalesce(list_cosine_similarity(CAST(lag(embedding) OVER w AS DOUBLE[]), CAST(embedding AS DOUBLE[])) >= 0.05, false) AS near
  FROM embeddings WINDOW w AS (PARTITION BY CAST(floor(vec_id / 10) AS BIGINT) ORDER BY vec_id)),
walk AS (SELECT doc, n, 1 AS part, len, 1 AS k FROM p WHERE n = 1
  UNION ALL SELECT w.doc, p.n, CASE WHEN p.near AND w.len + 1 + p.len <= 12 THEN w.part ELSE w.part + 1 END, CASE WHEN p.near AND w.len + 1 + p.len <= 12 THEN w.len + 1 + p.len ELSE p.len END, CASE WHEN p.near AND w.len + 1 + p.len <= 12 THEN w.k + 1 ELSE 1 END
  FROM walk w JOIN p ON p.doc = w.doc AND p.n = w.n + 1)
SELECT doc, part, CAST(max(len) AS INT) AS content, max(k) AS n_merged FROM walk GROUP BY doc, part""",
        "example_problems": f"SELECT id, CASE WHEN trim(a) = '' THEN 'empty_answer' WHEN a = '{P.REFUSAL}' THEN '' ELSE concat_ws(';', CASE WHEN len({stray}) > 0 THEN 'numbers_not_in_context:' || array_to_string({stray}, ',') END, CASE WHEN {cited} <> '' AND NOT contains(u, 'Điều ' || {cited}) THEN 'cited_dieu_not_in_context:' || {cited} END) END AS problems FROM ({VALIDATED})",
        "answer_leaks": f"""WITH r AS (SELECT id, split, kind, left({answer}, 400) AS k, md5(CAST(id AS VARCHAR)) AS o, NOT bad AS good FROM ({ANSWERED})), f AS (SELECT *, first_value(split) OVER (PARTITION BY k, good ORDER BY o, split) AS owner FROM r)
SELECT id, split, kind, good AND k <> '' AND kind <> 'refusal' AND owner <> split AS leak, good AND k <> '' AND owner <> split AS strict_leak FROM f""",
        "refusal_draws": "SELECT o_orderkey, CAST('0x' || left(md5('7' || chr(1) || o_orderkey || chr(1) || '0'), 8) AS BIGINT) / 4294967296.0 < 0.12 AS refuse FROM orders",
        "cited_names": f"SELECT p_partkey AS id, {_nth(1)} AS cited FROM part",
    }
