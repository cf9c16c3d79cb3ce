"""Text columns: prompts, replies, job logs and linter output."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalar import parse_number

# Wording of the two prompts.
RATE_PROMPT = (
    "Rate the fraud risk of this transaction from 0.0 (safe) to 1.0 (fraud). Reply with ONLY a number."
    "\n\nTransaction: "
)
SCORE_PROMPT = (
    "You are a fraud detection system. Score this transaction from 0.0 (legitimate) to 1.0 (fraud). "
    "Reply with ONLY a number.\n\n"
)

# Words that mark a log line as an error.
ERROR_WORDS = (
    "error", "exception", "traceback", "attributeerror", "typeerror", "valueerror", "failed to execute", "failed",
)
# Starts of lines that are left out of a stack trace.
TRACE_NOISE = ("ip-", "***", "▲▲▲", "▼▼▼", "[202")

# Time, header and link patterns of the logs, the note without blocks and the mark of a cut text.
BLOCK = (
    r"^\d{2}/\d{2}/\d{2}\s\d{2}:\d{2}:\d{2}\sERROR\sClient: Application diagnostics message: User class threw exception:.*?"
    r"(?=\n\d{2}/\d{2}/\d{2}\s\d{2}:\d{2}:\d{2}|\z)"
)
BLOCK_HEADER = (
    r"^\d{2}/\d{2}/\d{2}\s\d{2}:\d{2}:\d{2}\sERROR\sClient: Application diagnostics message: User class threw exception:.*?(?=$)"
)
NO_BLOCKS = (
    "No specific 'ERROR Client: Application diagnostics message: User class threw exception:' blocks found."
)
LOG_LINK = (
    r"s3://([a-z-]+-(\d+)-([a-z]{2}-[a-z]+-[1-9]))/emr_logs/(j-[\w\d]+)/steps/(s-[\w\d]+)/"
)
SNIPPET = 1500
CUT_MARK = "\n... [LOG TRUNCATED] ..."


def float_text(c: Column) -> Column:
    """A double as plain shortest text ('0.0001', '12.0', '1e-05'); Spark's own text has exponents earlier."""
    text = c.cast("string")
    digits = F.regexp_replace(F.regexp_extract(text, r"^-?([\d.]+)E", 1), r"\.0$|\.", "")
    power = F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int")
    sign = F.when(c < 0, "-").otherwise("")
    point = power + 1
    padded = F.rpad(digits, F.greatest(point, F.length(digits)), "0")
    tail = F.substring(padded, point + 1, F.length(padded))
    large = F.concat(F.substring(padded, F.lit(1), point), F.lit("."), F.when(tail == "", "0").otherwise(tail))
    small = F.concat(F.lit("0.000"), digits)
    rest = F.substring(digits, F.lit(2), F.length(digits))
    mantissa = F.concat(F.substring(digits, 1, 1), F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)))
    steps = F.abs(power).cast("string")
    exponent = F.concat(
        F.when(power < 0, "e-").otherwise("e+"), F.lpad(steps, F.greatest(F.length(steps), F.lit(2)), "0")
    )
    size = F.abs(c)
    return (
        F.when((size >= 1e-3) & (size < 1e7), text)
        .when(c == 0, text)
        .when(F.isnan(c), "nan")
        .when(size == float("inf"), F.concat(sign, F.lit("inf")))
        .when((power >= 7) & (power < 16), F.concat(sign, large))
        .when(power == -4, F.concat(sign, small))
        .otherwise(F.concat(sign, mantissa, exponent))
    )


def rate_prompt(desc: Column) -> Column:
    return F.concat(F.lit(RATE_PROMPT), F.coalesce(desc, F.lit("")))


def score_prompt(features: Sequence[str]) -> Column:
    parts: list[Column] = [F.lit(SCORE_PROMPT)]
    for i, name in enumerate(features):
        parts += [F.lit(f"{', ' if i else ''}{name}="), float_text(F.coalesce(F.col(name), F.lit(0.0)))]
    return F.concat(*parts)


def reply_score(reply: Column, fallback: float = 0.5) -> Column:
    """First token of a reply that is a number in [0, 1]; commas count as blanks."""
    tokens = F.split(F.replace(reply, F.lit(","), F.lit(" ")), r"(?U)\s+")
    numbers = F.filter(F.transform(tokens, parse_number), lambda x: (x >= 0) & (x <= 1))
    return F.coalesce(F.get(numbers, 0), F.lit(fallback))


def log_link_parts(log: Column) -> Column:
    """Bucket, account, region, cluster and step of the first log link line; nulls when there is none."""
    lines = F.filter(F.split(log, "\n"), lambda x: x.contains("LogFile: s3://"))
    url = F.trim(F.element_at(F.split(F.get(lines, 0), "LogFile: "), -1))
    names = ("bucket", "account", "region", "cluster_id", "step_id")
    return F.struct(
        *[F.nullif(F.regexp_extract(url, LOG_LINK, i + 1), F.lit("")).alias(n) for i, n in enumerate(names)]
    )


def error_lines(log: Column, words: Sequence[str] = ERROR_WORDS) -> Column:
    """Lines with an error word; else the stack trace without noise lines; else lines that start 'ERROR -'."""
    lines = F.split(log, "\n")
    # A word that holds another one says nothing more than that one.
    telling = [w for w in words if not any(o != w and o in w for o in words)]

    def tells(text: Column) -> Column:
        low = F.lower(text)
        return functools.reduce(operator.or_, [low.contains(w) for w in telling])

    def noise(line: Column) -> Column:
        bare = F.trim(line)
        hit = F.lit(False)
        for start in TRACE_NOISE:
            hit = hit | bare.startswith(start)
        return hit

    def chosen(hits: Column) -> Column:
        trace_text = F.regexp_extract(log, r"(?is)(Traceback \(most recent call last\):.*)", 1)
        trace = F.when(trace_text != "", F.filter(F.split(trace_text, "\n"), lambda x: ~noise(x)))
        plain = F.filter(lines, lambda x: F.trim(x).startswith("ERROR -"))
        return F.when(F.size(hits) > 0, hits).when(trace.isNotNull() & (F.size(trace) > 0), trace).otherwise(plain)

    # Most logs are cleared as a whole; the lines found are bound to a name, as they are tested and returned.
    hits = F.when(tells(log), F.filter(lines, tells)).when(log.isNotNull(), F.array().cast("array<string>"))
    return F.transform(F.array(hits), chosen)[0]


def error_blocks(log: Column, whole_block: bool = True) -> Column:
    """Diagnostics blocks of a driver log joined by newlines, or a note when there is none.

    ``whole_block`` takes all lines up to the next line that starts with a time. Without it only the header
    line is taken: that is what a lazy multi-line match that may stop at any line end yields.
    """
    pattern = BLOCK if whole_block else BLOCK_HEADER
    blocks = F.regexp_extract_all(log, F.lit(f"(?dms)({pattern})"), F.lit(1))
    return F.when(F.size(blocks) > 0, F.array_join(blocks, "\n")).otherwise(NO_BLOCKS)


LINT_SCHEMA = "array<struct<type:string,symbol:string,`message-id`:string,message:string,line:int>>"


def explode_lint(df: DataFrame, output: str, keep: Sequence[str]) -> DataFrame:
    """Messages of the JSON array between the first '[' and the last ']' of a linter's output, one row each."""
    text = F.col(output)
    start = F.locate("[", text)
    end = F.length(text) - F.locate("]", F.reverse(text)) + 1
    found = (start > 0) & F.contains(text, F.lit("]"))
    messages = F.from_json(F.when(found, F.substring(text, start, end - start + 1)), LINT_SCHEMA)
    m = F.col("_m")
    kind = F.upper(F.substring(F.coalesce(m["type"], F.lit("U")), 1, 1))
    return df.select(*keep, F.explode(messages).alias("_m")).filter(m.isNotNull()).select(
        *keep,
        kind.alias("issue_type"),
        F.coalesce(m["symbol"], F.lit("unknown")).alias("symbol"),
        F.coalesce(m["message-id"], F.lit("N/A")).alias("symbol_code"),
        F.coalesce(m["message"], F.lit("N/A")).alias("message"),
        F.coalesce(m["line"], F.lit(0)).alias("line_number"),
    )


def lint_score(text: Column) -> Column:
    return F.regexp_extract(text, r"rated at ([\d.]+)/10", 1).try_cast("double")


def snippet(text: Column, size: int = SNIPPET) -> Column:
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit(CUT_MARK))).otherwise(text)
