"""Scalar expressions over text, built from Spark functions: all stay in generated code."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a missing cell.
SENTINELS = ["", "nan", "none", "none none", "null", "n/a", "[]"]


def _latin() -> tuple[str, str]:
    """Accented Latin letters below U+0250, and their base letters, by Unicode's decompositions."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for c in range(0xC0, 0x250) if unicodedata.combining(unicodedata.normalize("NFKD", chr(c))[-1:] or "a")]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold(c: Column) -> Column:
    """Lower case without accents; null becomes empty. Combining marks go; letters past Latin Extended-B stay."""
    return F.lower(F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), *_latin()), r"\p{M}", ""))


def null_if_sentinel(c: Column) -> Column:
    """Null for every spelling of a missing cell, else the trimmed text."""
    t = F.trim(c)
    return F.when(F.lower(t).isin(SENTINELS), F.lit(None)).otherwise(t)


def first_filled(*cols: Column) -> Column:
    """The first cell that isn't missing; empty if all are."""
    return F.coalesce(*map(null_if_sentinel, cols), F.lit(""))


def let(c: Column, f) -> Column:
    """f of c, which is computed once however often f names it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def _skip(p: str, i: int) -> int:
    """The place after the escape, class, group or character at i."""
    if p[i] == "\\":
        return i + 2
    if p[i] == "[":
        i += 2 if p[i + 1] != "^" else 3  # a bracket that comes first is a member
        while p[i] != "]":
            i = _skip(p, i) if p[i] == "\\" else i + 1
    elif p[i] == "(":
        i += 1
        while p[i] != ")":
            i = _skip(p, i)
    return i + 1


def literals(pattern: str) -> list[list[str]]:
    """For each alternative of a pattern, the plain characters in lower case that every text it matches has, letter case aside."""
    runs, i = [[""]], 0
    while i < len(pattern):
        ch, end = pattern[i], _skip(pattern, i)
        plain = pattern[i + 1] if ch == "\\" and not pattern[i + 1].isalnum() else ch if ch not in "\\[(.^$|{}*+?" else ""
        plain = plain.lower() if plain.isascii() else ""
        more = pattern[end : end + 1]
        if ch == "|":
            runs.append([""])
        elif plain and more not in ("?", "*", "{"):
            runs[-1][-1] += plain
            if more == "+":
                runs[-1].append("")
        else:
            runs[-1].append("")
        if more == "{":
            end = pattern.index("}", end) + 1
        while pattern[end : end + 1] in ("?", "*", "+"):
            end += 1
        i = end
    return [sorted({x for x in r if x and not any(x in y and x != y for y in r)}) for r in runs]


def may_match(low: Column, pattern: str) -> Column:
    """False only where the pattern can't match the text whose lower case is low: a search for plain words costs a small part of a pattern's."""
    hit = F.lit(False)
    for words in literals(pattern):
        all_of = F.lit(True)
        for w in words:
            all_of = all_of & F.contains(low, F.lit(w))
        hit = hit | all_of
    return hit


def bounded(pattern: str) -> str:
    """The pattern, case aside, with \\b between ASCII's word characters and all others, whatever this Java takes for one."""
    return "(?i)" + pattern.replace(r"\b", r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))")


#: Of more patterns, each is tried alone, where its words occur.
FEW = 12


def matches_any(text: Column, patterns: list[str]) -> Column:
    if len(patterns) <= FEW:
        return text.rlike(bounded("(?:" + ")|(?:".join(patterns) + ")"))

    def any_of(t: Column) -> Column:
        def search(low: Column) -> Column:
            hit = F.lit(False)
            for p in patterns:
                hit = hit | (may_match(low, p) & t.rlike(bounded(p)))
            return hit

        return let(F.lower(t), search)

    return let(text, any_of)


def _each_matching(text: Column, patterns: list[str], worth) -> Column:
    """The sum of what the patterns that occur are worth, by their place."""

    def count(t: Column) -> Column:
        def search(low: Column) -> Column:
            total = F.lit(0)
            for i, p in enumerate(patterns):
                total = total + (may_match(low, p) & t.rlike(bounded(p))).cast("int") * F.lit(worth(i))
            return total

        return let(F.lower(t), search)

    return let(text, count)


def count_matching(text: Column, patterns: list[str]) -> Column:
    """How many of the patterns occur, each once."""
    return _each_matching(text, patterns, lambda i: 1)


def matching_bits(text: Column, patterns: list[str]) -> Column:
    """Which of the patterns occur, the first one's bit the lowest: bits of more texts are put together by OR."""
    return _each_matching(text, patterns, lambda i: 1 << i)


def contains_any(text: Column, words: list[str]) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | F.contains(text, F.lit(w))
    return hit


def url_domain(url: Column) -> Column:
    """Host of a URL, with or without a scheme, in lower case and without www; null if there is none."""
    u = F.lower(F.trim(url))
    host = F.regexp_extract(u, r"^(?:[a-z][a-z0-9+.-]*://)?(?:www\.)?([^/?#]*)", 1)
    return F.when(host != "", host)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def normal_url(url: Column) -> Column:
    """Lower case without scheme, www and a slash at the end."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(F.trim(url)), r"^https?://", ""), r"^www\.", ""), r"/+$", "")


def email_domain(email: Column) -> Column:
    return F.when(F.contains(email, F.lit("@")), F.lower(F.trim(F.substring_index(email, "@", -1))))


def name_parts(name: Column) -> tuple[Column, Column]:
    """First token and the rest; empty for missing names."""
    n = F.coalesce(null_if_sentinel(name), F.lit(""))
    return F.split(n, r"\s+", 2)[0], F.coalesce(F.get(F.split(n, r"\s+", 2), F.lit(1)), F.lit(""))


def us_phone(phone: Column) -> Column:
    """+1 (abc) def-ghij for 10 digits, or 11 that begin with 1; anything else as it is."""
    d = F.regexp_replace(phone, "[^0-9]", "")
    d = F.when((F.length(d) == 11) & d.startswith("1"), F.substring(d, 2, 10)).otherwise(d)
    set_out = F.concat(F.lit("+1 ("), F.substring(d, 1, 3), F.lit(") "), F.substring(d, 4, 3), F.lit("-"), F.substring(d, 7, 4))
    return F.when(F.length(d) == 10, set_out).otherwise(phone)


def valid_email(email: Column) -> Column:
    return F.coalesce(F.trim(email).rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"), F.lit(False))


def invalid_company(name: Column) -> Column:
    t = F.trim(F.coalesce(name, F.lit("")))
    return (F.length(t) <= 1) | ~t.rlike(r"[\p{L}\p{N}]")


#: A literal's strings, and what stands between them.
_TOKENS = r"""(?s)'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^'"]+|['"]"""


def _json_token(t: Column) -> Column:
    """A token as JSON has it; the patterns are tried only where there is what they are for."""
    inner = F.substr(t, F.lit(2), F.length(t) - 2)
    plain = F.regexp_replace(inner, r"(?s)(?<!\\)((?:\\\\)*)\\'", "$1'")
    plain = F.regexp_replace(plain, r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    escaped = F.regexp_replace(plain, r"""(?s)(?<!\\)((?:\\\\)*)\\?\"""", r"""$1\\\"""")
    quoted = F.concat(F.lit('"'), F.when(F.contains(t, F.lit("\\")), escaped).otherwise(F.replace(inner, F.lit('"'), F.lit('\\"'))), F.lit('"'))
    bare = t
    for word, other in (("None", "null"), ("True", "true"), ("False", "false")):
        bare = F.regexp_replace(bare, rf"\b{word}\b", other)
    bare = F.when(contains_any(t, ["None", "True", "False"]), bare).otherwise(t)
    bare = F.translate(bare, "()", "[]")
    bare = F.when(F.contains(t, F.lit(",")), F.regexp_replace(bare, r",(\s*[\]}])", "$1")).otherwise(bare)
    return F.when((F.length(t) > 1) & (t.startswith("'") | t.startswith('"')), quoted).otherwise(bare)


def literal_json(c: Column) -> Column:
    """A Python literal (lists, tuples, dicts, strings of either quote, numbers, None, True, False) as JSON; JSON stays as it is.

    The text is read as a run of whole strings and of what stands between them, so quotes, commas and words within strings
    stay. What is no literal gives a text that no JSON reader takes.
    """
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_TOKENS), F.lit(0)), _json_token), "")


def literal_object(c: Column) -> Column:
    """A cell with a dict literal or JSON object as JSON; {} from anything else."""
    read = let(literal_json(c), lambda t: F.when(t.rlike(r"^\s*\{") & F.try_parse_json(t).isNotNull(), t))
    return F.coalesce(read, F.lit("{}"))


def parse_list(c: Column) -> Column:
    """A list cell as an array: JSON, a Python literal, or separated by ; or ,. Missing cells are empty arrays; lists within are JSON texts."""
    t = null_if_sentinel(c)
    marked = t.rlike(r"(?s)^[\[(].*[\])]$")
    read = F.from_json(F.when(marked, literal_json(t)), "array<string>", {"allowUnquotedControlChars": "true"})
    parts = F.filter(F.transform(F.split(F.regexp_replace(t, r"^\[|\]$", ""), "[;,]"), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(F.when(marked, read), parts, F.array().cast("array<string>"))


def days_between(later: Column, earlier: Column) -> Column:
    """Whole spans of 24 hours, not calendar days."""
    return F.floor((F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(86_400_000_000)).cast("long")


def parse_time(c: Column) -> Column:
    """A timestamp from epoch seconds, a date, or an ISO form; null from anything else."""
    t = F.trim(c)
    epoch = F.timestamp_seconds(F.expr("try_cast(0 as bigint)") + t.try_cast("bigint"))
    return F.coalesce(F.when(t.rlike(r"^\d{9,11}$"), epoch), F.try_to_timestamp(t), F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(t, F.lit("yyyy-MM-dd")))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))
