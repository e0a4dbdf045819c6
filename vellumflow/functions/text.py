"""Text, path and routing expressions; all native, none a UDF."""

from __future__ import annotations

from functools import reduce
from string import Formatter

from pyspark.sql import Column, DataFrame, functions as F

from vellumflow import vocabulary as V


def fill(template: str, **values: Column) -> Column:
    """Fill the ``{names}`` of a fixed text from columns; NULL fills as empty."""
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(F.coalesce(values[name].cast("string"), F.lit("")))
    return F.concat(*parts)


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def classify_intent(message: Column) -> Column:
    """First intent whose word list has a substring in the message."""
    lowered = F.lower(message)
    chain = F
    for name, words in V.INTENTS:
        chain = chain.when(contains_any(lowered, words), F.lit(name))
    return chain.otherwise(F.lit(V.GENERAL_INTENT))


def classify_refresh(message: Column) -> Column:
    return F.when(contains_any(F.lower(message), V.REFRESH_WORDS), F.lit("refresh")).otherwise(F.lit("search"))


def document_path(message: Column) -> Column:
    """First source-document path in the message, else NULL."""
    found = F.regexp_extract(message, V.SOURCE_PATH_PATTERN, 0)
    return F.nullif(found, F.lit(""))


def volume_path(message: Column) -> Column:
    """First whitespace token under a volume, for extract requests only."""
    tokens = F.filter(F.split(message, r"\s+"), lambda t: t.contains(V.VOLUME_MARK))
    return F.when(F.lower(message).contains("extract"), F.try_element_at(tokens, F.lit(1)))


def volume_reply(message: Column) -> Column:
    """The prompt for a path when an extract request has none, else NULL."""
    asks = F.lower(message).contains("extract")
    return F.when(asks & volume_path(message).isNull(), F.lit(V.MSG_NO_VOLUME_PATH))


def parse_run_id(text: Column) -> Column:
    """First digits of ``RunId(123)`` or ``123`` as BIGINT, else NULL."""
    return F.regexp_extract(text, r"[0-9]+", 0).try_cast("long")


def unix_lines(text: Column) -> Column:
    """Normalize line ends as a text-mode read does."""
    return F.regexp_replace(text, r"\r\n?", "\n")


def page_count(text: Column, page_break: str = V.PAGE_BREAK) -> Column:
    """Non-overlapping page breaks plus one."""
    breaks = F.char_length(text) - F.char_length(F.replace(text, F.lit(page_break), F.lit("")))
    return ((breaks / len(page_break)).cast("int") + 1).cast("int")


def normalized(message: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(message, r"\s+", " ")))


def preview(text: Column, n: int = 500) -> Column:
    return F.left(text, F.lit(n))


def sql_quoted(text: Column) -> Column:
    """Double the single quotes of a value bound for a SQL literal."""
    return F.replace(text, F.lit("'"), F.lit("''"))


def user_of_address(address: Column) -> Column:
    return F.substring_index(address, "@", 1)


def paths_like(df: DataFrame, path: str, like: str, contains: str = "", suffix: str = "") -> DataFrame:
    """Rows whose path matches a LIKE pattern, a substring and a suffix."""
    p = F.col(path)
    return df.filter(p.like(like) & p.contains(contains) & p.endswith(suffix))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def compose_id(prefix: str, run_id: Column) -> Column:
    return F.concat(F.lit(prefix), run_id.cast("string"))


def stable_id(*parts: Column) -> Column:
    """UUID-shaped id derived from its key, so a retried task repeats it. Each part is
    preceded by its length (none for NULL), so different keys never read the same."""
    sized = [F.concat(F.coalesce(F.char_length(p.cast("string")).cast("string"), F.lit("")), F.lit(":"), F.coalesce(p.cast("string"), F.lit(""))) for p in parts]
    digest = F.md5(F.concat(*sized))
    return F.concat_ws("-", *[F.substr(digest, F.lit(at), F.lit(n)) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def leading_sentences(text: Column, n: int = 3) -> Column:
    """The first ``n`` sentences; a text without sentence ends stays whole."""
    lead = F.regexp_extract(text, r"^(?:[^.!?]*[.!?]+){1,%d}" % n, 0)
    return F.trim(F.when(lead == "", text).otherwise(lead))


def build_prompt(text: Column) -> Column:
    """The two chat messages of a summary request."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(
        message("system", F.lit(V.SYSTEM_PROMPT)),
        message("user", F.concat(F.lit(V.USER_PROMPT), text)),
    )


def chat_choices(content: Column) -> Column:
    """Chat response body: one assistant choice."""
    return F.array(
        F.struct(
            F.lit(0).alias("index"),
            F.struct(F.lit("assistant").alias("role"), content.alias("content")).alias("message"),
            F.lit("stop").alias("finish_reason"),
        )
    )


def last_of(messages: Column) -> Column:
    """Content of the last message of a chat array; a fixed text when there is none."""
    return F.coalesce(F.try_element_at(messages, F.lit(-1)).getField("content"), F.lit(V.MSG_EMPTY))
