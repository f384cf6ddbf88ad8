"""Quality checks over chunks: flags per chunk, findings, statistics, samples and the clean copy.

Input columns: seq (the order of the rows), chunk_id, doc_id, link, name, dieu, part, title_confident, content, char_len
and structure; absent ones count as null. Equal texts meet by a hash, not by their text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import patterns as P
from ..functions import text as T

S = T.S
FATAL = tuple(name for name, severity, _ in P.CHECKS if severity == "FATAL")
_NOISE = ("exact_dup", "near_dup", "toc", "boilerplate", "all_caps", "junk_ratio", "too_short")
#: Checks whose rows a profile leaves out, besides the fatal ones.
PROFILES = {"rag": _NOISE, "train": (*_NOISE, "not_vietnamese", "self_repeating")}
COLUMNS = {"seq": "long", "chunk_id": "string", "doc_id": "string", "link": "string", "name": "string", "structure": "string", "dieu": "string", "part": "string", "title_confident": "boolean", "content": "string", "char_len": "long"}


def with_columns(chunks: DataFrame) -> DataFrame:
    have = set(chunks.columns)
    return chunks.withColumns({c: F.col(c).cast(t) if c in have else F.lit(None).cast(t) for c, t in COLUMNS.items()})


def content_flags(c: Column) -> dict[str, Column]:
    """Checks that look at the text alone."""
    size = F.length(c)
    low = F.lower(c)
    heading = rf"Điều(?<![{P.LOWER}] Điều){S}+\p{{Nd}}{{1,3}}{S}*[.:]"
    count = lambda pattern: size - F.length(F.regexp_replace(c, pattern, ""))
    letters, upper = count(r"\p{L}++"), count(r"(?:(?=\p{L})\p{IsUppercase})++")
    junk = F.regexp_count(c, F.lit(r"[\p{Nd}.,;:/()\[\]%–—-]"))
    common = reduce(Column.__add__, (F.contains(low, F.lit(w)).cast("int") for w in P.COMMON_WORDS))
    opening = "|".join(f"\\{m}" if m in ")+-" else m for m in P.FRAGMENT_MARKS)
    return {
        "toc": F.regexp_count(c, F.lit(heading)) >= 4,
        "boilerplate": (size < 600) & F.exists(F.array(*map(F.lit, P.BOILERPLATE)), lambda m: F.contains(c, m)),
        "fragment_start": c.rlike(rf"^{S}*+(?:{opening})") | T.first_letter(c).rlike(r"^\p{IsLowercase}"),
        "junk_ratio": (size > 80) & (junk / size > 0.35),
        "all_caps": (letters > 40) & (upper / letters > 0.75),
        "not_vietnamese": (size > 200) & (common < 2),
        "self_repeating": T.shingle_diversity(c) < 0.7,
    }


def flag_chunks(chunks: DataFrame, min_chars: int = 120, max_tokens: int = 512, tokens: Column | None = None, has_char_len: bool | None = None) -> DataFrame:
    """chunks with n_chars, n_tokens, scored and one boolean column per check. seq names a row and its place.

    Exact copies are nested in near copies, and those in template copies; so a row is a near copy if it is the first of
    its text but not of its near key, and likewise for templates. Repeats are found among keys alone: texts move once
    at most, to be joined with the flags of the rows that are repeats.
    """
    key_present = "char_len" in chunks.columns if has_char_len is None else has_char_len
    rows = with_columns(chunks).withColumn("content", T.text_or_empty(F.col("content")))
    c = F.col("content")
    sized = rows.withColumns({"n_chars": F.length(c), "scored": T.strip(c) != "", "n_tokens": T.estimated_tokens(c) if tokens is None else tokens})
    scored = F.col("scored")
    blank = lambda name: F.coalesce(T.strip(F.col(name)) == "", F.lit(True))
    part = F.coalesce(F.expr("try_cast(part AS int)"), F.lit(1))
    head = F.left(c, F.length("dieu") + 40)
    flags = {
        "empty_content": ~scored,
        "char_len_mismatch": ~F.col("char_len").eqNullSafe(F.col("n_chars").cast("long")) if key_present else F.lit(False),
        "over_budget": scored & (F.col("n_tokens") > max_tokens),
        "no_dieu": scored & blank("dieu"),
        "title_guessed": scored & F.col("title_confident").eqNullSafe(False),
        "no_link": scored & (F.coalesce("link", F.lit("")) == "") & (F.coalesce("name", F.lit("")) == ""),
        "orphan_part": scored & (part > 1) & ~blank("dieu") & (F.instr(head, F.left(F.col("dieu"), F.lit(24))) == 0),
        "too_short": scored & (F.col("n_chars") < min_chars),
    } | {k: scored & v for k, v in content_flags(c).items()}
    flagged = sized.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in flags.items()})
    found = repeats(rows)
    return flagged.join(found, "seq", "left").withColumns({k: F.coalesce(k, F.lit(False)) for k in REPEATS})


REPEATS = ("dup_chunk_id", "exact_dup", "near_dup", "template_dup")


def repeats(rows: DataFrame) -> DataFrame:
    """(seq, dup_chunk_id, exact_dup, near_dup, template_dup) of the rows that are any of these.

    Rows are first reduced to one a text, combined before they are shuffled, so no common text lands in one task; near
    keys and templates are compared among these.
    """
    c = F.col("content")
    cid = F.coalesce(F.nullif("chunk_id", F.lit("")), F.concat(F.lit("line"), F.col("seq")))
    ids = rows.select("seq", F.xxhash64(cid).alias("a"), F.md5(cid).alias("b"))
    ids = ids.join(ids.groupBy("a", "b").agg(F.min("seq").alias("first")), ["a", "b"]).where("seq > first")
    ids = ids.select("seq", F.lit(True).alias("dup_chunk_id"), *(F.lit(False).alias(r) for r in REPEATS[1:]))
    keys = rows.where(T.strip(c) != "").select("seq", F.md5(c).alias("h0"), T.near_key(c).alias("near"))
    keys = keys.select("seq", "h0", F.md5("near").alias("h1"), F.md5(T.template_key(F.col("near"))).alias("h2"))
    texts = keys.groupBy("h0").agg(F.min("seq").alias("f0"), F.first("h1").alias("h1"), F.first("h2").alias("h2"))
    least = lambda k: F.min("f0").over(Window.partitionBy(k))
    texts = texts.withColumn("f1", least("h1")).withColumn("f2", least("h2")).select("h0", "f0", "f1", "f2")
    seq, f0, f1, f2 = map(F.col, ("seq", "f0", "f1", "f2"))
    found = keys.select("seq", "h0").join(texts, "h0").select("seq", F.lit(False).alias("dup_chunk_id"), (seq > f0).alias("exact_dup"), ((seq == f0) & (f0 > f1)).alias("near_dup"), ((seq == f1) & (f1 > f2)).alias("template_dup"))
    found = found.where("exact_dup or near_dup or template_dup")
    return ids.union(found).groupBy("seq").agg(*(F.bool_or(r).alias(r) for r in REPEATS))


FLAGS = tuple(name for name, _, _ in P.CHECKS if name != "bad_json")


def hits(flagged: DataFrame) -> DataFrame:
    """flagged with the array of the checks that hit each row, in registry order."""
    return flagged.withColumn("hits", F.filter(F.array(*(F.when(F.col(n), F.lit(n)) for n in FLAGS)), lambda x: x.isNotNull()))


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, s, m, i) for i, (n, s, m) in enumerate(P.CHECKS)], "check string, severity string, meaning string, ord int")


def findings(flagged: DataFrame, bad_json: int = 0) -> DataFrame:
    """(check, severity, count, share, meaning, ord, place) of all checks; share is in percent of the scored rows.

    place orders them for a report: by severity, within it the most frequent first.
    """
    sums = flagged.agg(F.count_if("scored").alias("n"), *(F.count_if(n).alias(n) for n in FLAGS))
    long_ = sums.withColumn("bad_json", F.lit(bad_json).cast("long")).unpivot(["n"], [n for n, _, _ in P.CHECKS], "check", "count")
    share = F.bround(F.lit(100.0) * F.col("count") / F.greatest(F.col("n"), F.lit(1)), 2)
    rank = F.array_position(F.array(*map(F.lit, ("FATAL", "RAG", "TRAINING", "INFO"))), F.col("severity"))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(rank, F.desc("count"), "ord"))  # one row a check
    return registry(flagged.sparkSession).join(long_, "check").select("check", "severity", "count", share.alias("share"), "meaning", "ord", place.alias("place"))


def _statistics(column: str, prefix: str = "") -> list[Column]:
    """Nearest-rank percentiles, extremes, mean and total of a column, its nulls left out; zeros without any value."""
    zero = F.lit(0)
    p = lambda q: F.coalesce(F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY `{column}`)"), zero)
    return [
        F.coalesce(F.min(column), zero).alias(f"{prefix}min"), p(0.25).alias(f"{prefix}p25"), p(0.5).alias(f"{prefix}median"), p(0.75).alias(f"{prefix}p75"), p(0.95).alias(f"{prefix}p95"),
        F.coalesce(F.max(column), zero).alias(f"{prefix}max"), F.coalesce(F.rint(F.avg(column)), F.lit(0.0)).cast("long").alias(f"{prefix}mean"), F.coalesce(F.sum(column), zero).alias(f"{prefix}total"),
    ]


def length_stats(flagged: DataFrame, column: str = "n_chars", prefix: str = "") -> DataFrame:
    """Statistics of a column over the scored rows."""
    return flagged.where("scored").agg(*_statistics(column, prefix))


def samples(flagged: DataFrame, per_check: int = 5) -> DataFrame:
    """The first rows of each check, in the order of the rows."""
    rows = hits(flagged).select("seq", "chunk_id", "n_chars", F.left("dieu", F.lit(120)).alias("dieu"), F.left("content", F.lit(400)).alias("content"), F.explode("hits").alias("check"))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("check").orderBy("seq"))).where(F.col("rank") <= per_check)
    return rows.join(F.broadcast(registry(flagged.sparkSession)), "check").select("ord", "rank", "check", "chunk_id", "severity", F.col("meaning").alias("why"), F.col("n_chars").alias("chars"), "dieu", "content")


def clean_rows(flagged: DataFrame, drop: tuple[str, ...] | str = "rag") -> DataFrame:
    """Rows that neither a fatal check nor one of the profile hit."""
    wanted = {*FATAL, *(PROFILES[drop] if isinstance(drop, str) else drop)} - {"bad_json"}
    none = ~F.lit(False)
    for n in sorted(wanted):
        none = none & ~F.col(n)
    return flagged.where(none)


def report(flagged: DataFrame, chunks_file: str = "", bad_json: int = 0, max_tokens: int = 512, kept: int | None = None) -> DataFrame:
    """The audit as one row: counts, structures, statistics, findings and whether the run failed."""
    shapes = flagged.where("scored").groupBy(F.coalesce("structure", F.lit("?")).alias("s")).count().agg(F.map_from_entries(F.collect_list(F.struct("s", "count"))).alias("by_structure"))
    everything = [F.count("*").alias("rows_read"), F.count_if("scored").alias("chunks_scored"), *_statistics("_chars", "c_"), *_statistics("_tokens", "t_"), *(F.count_if(n).alias(n) for n in FLAGS)]
    sized = flagged.withColumns({"_chars": F.when(F.col("scored"), F.col("n_chars")), "_tokens": F.when(F.col("scored"), F.col("n_tokens"))})
    one = sized.agg(*everything).withColumn("bad_json", F.lit(bad_json).cast("long")).crossJoin(shapes)  # one row each
    share = lambda n: F.bround(F.lit(100.0) * F.col(n) / F.greatest(F.col("chunks_scored"), F.lit(1)), 2)
    found = F.map_from_entries(F.array(*(F.struct(F.lit(n), F.struct(F.lit(s).alias("severity"), F.col(n).alias("count"), share(n).alias("share"), F.lit(m).alias("meaning"))) for n, s, m in P.CHECKS)))
    fatal = F.lit(0).cast("long")
    for n in FATAL:
        fatal = fatal + F.col(n)
    length = F.struct(F.lit("characters").alias("unit"), *(F.col(f"c_{k}").alias(k) for k in ("min", "p25", "median", "p75", "p95", "max", "mean")))
    tokens = F.struct(*(F.col(f"t_{k}").alias(k) for k in ("median", "p95", "max", "total")), F.lit(max_tokens).alias("over_budget_at"))
    return one.select(F.lit(chunks_file).alias("chunks_file"), "rows_read", "chunks_scored", F.lit(kept).cast("long").alias("kept_in_clean_file"), "by_structure", length.alias("length"), tokens.alias("tokens"), found.alias("findings"), (fatal > 0).alias("failed"))


def exit_status(report_: DataFrame) -> int:
    """1 if a fatal check hit anything, as a command line would end."""
    return int(report_.first()["failed"])
