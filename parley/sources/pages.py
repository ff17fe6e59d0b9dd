"""Raw export pages: one file per API answer, holding a Python literal.

A page becomes one row ``(file_name, value)``; ``decode_literal`` adds ``json``. The answer
itself does not name its channel or parent message: these stand in the file name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from parley.sources.files import exists

# File name prefixes of the page kinds.
PAGE_PREFIXES = {
    "users": "user_list",
    "channels": "conversation_list",
    "messages": "conversation_history-",
    "threads": "conversation_replies-",
    "files": "files_list-",
    "flat_messages": "message_list-",
}

_PAGES = "file_name string, value string"

#: Bytes in an Arrow batch of pages. A page has any length, and a worker holds several copies of a batch.
BATCH_BYTES = 4 << 20


def read_pages(spark: SparkSession, home: str, batch: str, kind: str | None = None) -> DataFrame:
    """The pages of a batch, or those of one kind, in one listing and one read.

    The folder itself is the path and the names are filtered: a glob over single files would
    make each of them a path of its own, to be listed one by one.
    """
    folder = f"{home}/{batch}/api"
    if not exists(spark, folder):
        return spark.createDataFrame([], _PAGES)
    names = f"{PAGE_PREFIXES[kind] if kind else ''}*.json"
    pages = spark.read.option("pathGlobFilter", names).text(folder, wholetext=True)
    return pages.select(F.col("_metadata.file_name").alias("file_name"), "value")


def page_kind(file_name: Column | str = "file_name") -> Column:
    """The kind of a page by its name; null for other files."""
    name = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.coalesce(
        *[F.when(name.startswith(prefix), kind) for kind, prefix in PAGE_PREFIXES.items()]
    )


def page_clock(file_name: Column | str = "file_name") -> Column:
    """Microseconds at which the page was fetched: the order of the pages of one kind."""
    return F.regexp_extract(file_name, r"(\d{16})\.json$", 1).try_cast("bigint")


def page_channel(file_name: Column | str = "file_name") -> Column:
    """Channel of a history, reply or message page; null for other pages."""
    pattern = r"^(?:conversation_history|conversation_replies|message_list)-([^_]+?)(?:_[^-]*)?-\d{16}\.json$"
    return F.nullif(F.regexp_extract(file_name, pattern, 1), F.lit(""))


def page_parent(file_name: Column | str = "file_name") -> Column:
    """Id of the parent message of a reply page; null for other pages."""
    pattern = r"^conversation_replies-.*_([^_]+)-\d{16}\.json$"
    return F.nullif(F.regexp_extract(file_name, pattern, 1), F.lit(""))


def page_keys(pages: DataFrame) -> DataFrame:
    return pages.withColumns(
        {"channel": page_channel(), "parent_ts": page_parent(), "page_clock": page_clock()}
    )


def literal_json(value: Column | str) -> Column:
    """JSON text of a Python literal, null where the text is none.

    Pages are printed dicts and lists, so rewriting their strings and constants is enough and
    much faster than building the values. What does not come out as JSON that way (tuples,
    prefixed strings, odd numbers, no literal at all) goes through ``ast.literal_eval``.
    """

    def converter():
        # Imported here: the function travels to workers which need not have this package.
        import ast
        import json
        import re

        # A run of strings without quotes or escapes inside, and what stands between them; any
        # other string; a word.
        run = r"""'[^'\\"]*'(?:[\s:,\[\]{}0-9.-]+'[^'\\"]*')*"""
        string = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*\""""
        tokens = re.compile(f"{run}|{string}|[A-Za-z_]+", re.DOTALL)
        constants = {"None": "null", "True": "true", "False": "false"}
        # Escapes which mean the same in JSON, up to the quote.
        single = re.compile(r"(?:[^\\]|\\[nrt\\'])*", re.DOTALL)
        double = re.compile(r'(?:[^\\]|\\[nrt\\"])*', re.DOTALL)

        def rewrite(match) -> str:
            token = match.group()
            quote, body = token[0], token[1:-1]
            if quote == "'":
                if "\\" not in token and '"' not in token:
                    return token.replace("'", '"')
                if single.fullmatch(body):
                    return '"' + body.replace("\\'", "'").replace('"', '\\"') + '"'
            elif quote == '"':
                if double.fullmatch(body):
                    return token
            else:
                return constants[token]
            return json.dumps(ast.literal_eval(token))

        def to_json(text: str | None) -> str | None:
            if text is None:
                return None
            try:
                out = tokens.sub(rewrite, text)
                parsed = json.loads(out)
                return json.dumps(parsed) if "\n" in out else out
            except (KeyError, ValueError, SyntaxError, RecursionError):
                pass
            try:
                return json.dumps(ast.literal_eval(text))
            except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
                return None

        return to_json

    @F.pandas_udf(StringType())
    def convert(values: pd.Series) -> pd.Series:
        return values.map(converter())

    return convert(value)


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of pages small, so that the memory of a Python worker does not follow
    the number of pages in its task. A smaller size of the caller stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if held > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def decode_literal(pages: DataFrame) -> DataFrame:
    """Add the page as JSON text. A page which cannot be parsed gets null (``bad_pages``).

    The tokens ``None``, ``True`` and ``False`` are no JSON, and replacing them would change
    message texts too, so this one step needs Python.
    """
    small_batches(pages.sparkSession)
    return pages.withColumn("json", literal_json("value"))


def bad_pages(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("json").isNull()).select("file_name", "value")


# The list which a page of each kind holds; pages of the second product are lists themselves.
LIST_FIELDS = {
    "users": "members", "channels": "channels", "messages": "messages", "threads": "messages",
    "files": "files",
}


def page_faults(decoded: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """(file_name, reason) of decoded pages (file_name, json, kind) which would give no rows.

    ``fields`` names the list by kind; a kind without one must be a list itself. A page whose
    list is empty is no fault.
    """
    fields = LIST_FIELDS if fields is None else fields
    is_list = F.ltrim("json").startswith("[")
    reason = F.when(F.col("json").isNull(), "undecodable")
    for kind, field in fields.items():
        held = F.get_json_object("json", f"$.{field}")
        lacks = ~F.coalesce(F.ltrim(held).startswith("["), F.lit(False))
        reason = reason.when((F.col("kind") == kind) & lacks, f"no list of {field}")
    others = ~F.col("kind").isin(*fields) if fields else F.lit(True)
    reason = reason.when(others & ~is_list, "no list")
    return decoded.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("file_name", "reason")


def normalize_pages_to_json(pages: DataFrame) -> DataFrame:
    """Each page as JSON text under its own file name, for one distributed write. Pages of
    several batches keep their ``batch_id``."""
    batch = [c for c in ("batch_id",) if c in pages.columns]
    return decode_literal(pages).select("file_name", "json", *batch)


def process_pages(
    pages: DataFrame,
    function: Callable[..., pd.DataFrame],
    schema: str,
    **arguments: object,
) -> DataFrame:
    """Run a user function on every decoded page: ``function(infile, result, **arguments)``.

    ``result`` is the parsed page; the returned frame must have the columns of ``schema``. Pages
    that cannot be parsed are left out here: as a filter of the plan, this would decode all twice.
    """
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        for batch in batches:
            for name, text in zip(batch["file_name"], batch["json"]):
                if text is not None:
                    yield function(infile=name, result=json.loads(text), **arguments)

    decoded = pages if "json" in pages.columns else decode_literal(pages)
    return decoded.select("file_name", "json").mapInPandas(run, schema)
