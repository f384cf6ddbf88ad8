"""Text functions as columns; all but tokenizer_tokens() run in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

S, NOT_S = f"[{P.WS}]", f"[^{P.WS}]"
#: The characters of that class, for functions that look at the ends of a text only.
SPACES = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))



def nfc(c: Column) -> Column:
    """Canonical composition, which Spark has no function for but the ICU library that it comes with has; null stays null
    and texts of one-byte characters stay as they are."""
    composed = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text_or_empty(c), F.lit(False))
    return F.when(c.isNull() | (F.length(c) == F.octet_length(c)), c).otherwise(composed)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often it is used; plans would otherwise repeat the whole expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(SPACES))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(SPACES))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(SPACES))


def normalize_text(c: Column) -> Column:
    """Composed, with line feeds only, without zero-width and direction marks."""
    c = F.regexp_replace(nfc(text_or_empty(c)), "\r\n?", "\n")
    return F.regexp_replace(F.replace(c, F.lit("\u00a0"), F.lit(" ")), "[\ufeff\u200b-\u200f\u202a-\u202e]", "")


def clean_content(c: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, rf"{S}++", " "))


def near_key(c: Column) -> Column:
    """Letters and digits only, in lower case. Texts are taken to be composed, as this library's chunks are; see nfc()."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]++", "")


def template_key(near: Column) -> Column:
    """A near key with every number folded to 0."""
    return F.regexp_replace(near, r"\p{Nd}++", "0")


def estimated_tokens(c: Column, ratio: float = 2.4) -> Column:
    return F.greatest(F.lit(1), F.rint(F.length(c) / F.lit(ratio)).cast("int"))


def tokenizer_tokens(c: Column, path: str) -> Column:
    """Tokens by a tokenizer file of the tokenizers library, without special ones; null counts as empty. The path must be
    readable on the workers, each of which loads the file once."""

    @F.pandas_udf("int")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        for part in texts:
            yield pd.Series([len(e.ids) for e in tokenizer.encode_batch(part.fillna("").tolist(), add_special_tokens=False)], dtype="int32")

    return count(c)


def first_letter(c: Column) -> Column:
    return F.regexp_extract(c, r"\p{L}", 0)


def words(c: Column) -> Column:
    return F.filter(F.split(c, rf"{S}+"), lambda w: w != "")


def shingle_diversity(c: Column, n: int = 8) -> Column:
    """Distinct n-word shingles over all, told apart by 64-bit hashes; 1 for fewer than 4 n words."""

    def share(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, n)))
        return F.when(F.size(w) < 4 * n, 1.0).otherwise(let(grams, lambda g: F.size(F.array_distinct(g)) / F.size(g)))

    return let(words(c), share)


def name_from_link(link: Column) -> Column:
    """The last part of a link without its page suffix, dashes as spaces."""
    last = F.element_at(F.split(F.regexp_replace(text_or_empty(link), "/+$", ""), "/"), -1)
    for suffix in (r"\.aspx$", r"\.html$", r"\.htm$"):
        last = F.regexp_replace(last, suffix, "")
    return strip(F.replace(last, F.lit("-"), F.lit(" ")))


def pretty_doc_name(name: Column, link: Column | None = None) -> Column:
    """A citation-like name for a slug; names with diacritics stay."""
    raw = strip(text_or_empty(name))
    if link is not None:
        last = F.element_at(F.split(F.regexp_replace(text_or_empty(link), "/+$", ""), "/"), -1)
        raw = F.when(raw == "", F.regexp_replace(last, r"-\p{Nd}+\.(?:aspx|html?)$", "")).otherwise(raw)
    slug = F.lower(raw)
    out = F.when(raw == "", "").when(raw.rlike(f"(?iu)[{P.LOWER_LETTERS.replace('a-z', '')}]"), raw)
    for prefix, label in P.DOCUMENT_KINDS:
        rest = F.substring(raw, len(prefix) + 2, 1_000_000)
        code = r"^(\p{Nd}+)[-/](\p{Nd}{4})[-/]([A-ZĐa-zđ\-]+)$"
        letters = F.regexp_replace(F.upper(F.regexp_extract(rest, code, 3)), "^([^D]*)D", "$1Đ")
        cited = F.concat(F.lit(label + " "), F.regexp_extract(rest, code, 1), F.lit("/"), F.regexp_extract(rest, code, 2), F.lit("/"), letters)
        plain = F.concat(F.lit(label + " "), F.replace(rest, F.lit("-"), F.lit(" ")))
        out = out.when(F.startswith(slug, F.lit(prefix + "-")), F.when(rest.rlike(code), cited).otherwise(plain))
    return out.otherwise(F.replace(raw, F.lit("-"), F.lit(" ")))


def article_label(c: Column) -> Column:
    """Spelling variants of the article word before a number become the usual one."""
    return F.regexp_replace(text_or_empty(c), rf"(?U:\b)(?:Ðiều|ĐIỀU|ÐIỀU|Điền|Ðiền)(?={S}+\p{{Nd}})", "Điều")


def title_only(c: Column) -> Column:
    return strip(F.regexp_replace(text_or_empty(c), rf"^{S}*(?:Điều|Ðiều|ĐIỀU|Điền){S}+\p{{Nd}}{{1,3}}[a-zđ]?{S}*[.:]{S}*", ""))


def article_number(c: Column) -> Column:
    return F.regexp_extract(text_or_empty(c), rf"(?:Điều|Ðiều|ĐIỀU|Điền){S}+(\p{{Nd}}{{1,3}}[a-zđ]?)", 1)


def without_title(content: Column, title: Column) -> Column:
    """Content without the title repeated at its head; the content itself if nothing is left."""
    body, head = lstrip(text_or_empty(content)), strip(text_or_empty(title))
    rest = F.regexp_replace(F.substr(body, F.length(head) + 1), "^[ —–:.-]+", "")
    rest = strip(F.when((head != "") & F.startswith(body, head), rest).otherwise(body))
    return F.when(rest == "", strip(text_or_empty(content))).otherwise(rest)


def sentences(c: Column) -> Column:
    """Sentences of Vietnamese prose; abbreviations, initials and numbered runs don't end one."""
    names = "|".join(a.replace(".", r"\.") for a in P.ABBREVIATIONS)
    guard = rf"(?<!(?<![\p{{L}}\p{{N}}_])(?:{names})\.)(?<!(?<![\p{{L}}\p{{N}}_])[{P.UPPER}]\.)(?!(?<=\p{{Nd}}\.){S}*+\p{{Nd}})"
    parts = F.split(c, rf"(?<=[.!?]){guard}{S}+(?=[{P.UPPER}\p{{Nd}}\"“(\[])")
    return F.filter(F.transform(parts, strip), lambda s: s != "")
