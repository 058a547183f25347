"""Readers and writers (#1-#3)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.columns import nulls_for_nan, numeric_or_null, q, trim_ws

# Text that counts as missing when a CSV is read leniently; the strict
# default is the single token "?" (the census file's marker).
LENIENT_NULL_TOKENS = ["?", "", "NA", "N/A", "NaN", "nan", "null", "NULL", "None"]
STRICT_NULL_TOKENS = ["?"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a test-data directory, NaN turned into NULL."""
    return nulls_for_nan(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def safe_name(name: str) -> str:
    """Spark treats '.' as field access: dots (and other separators) become '_'."""
    return re.sub(r"[.\s]+", "_", name.strip())


def rename_safe(df: DataFrame) -> DataFrame:
    """Rename columns to :func:`safe_name`, keeping the original name as metadata."""
    cols = []
    for f in df.schema.fields:
        new = safe_name(f.name)
        cols.append(F.col(q(f.name)).alias(new, metadata={"source_name": f.name}))
    return df.select(*cols)


def null_tokens(df: DataFrame, tokens=STRICT_NULL_TOKENS, subset: list[str] | None = None) -> DataFrame:
    """Exact-match replacement of marker values by NULL in every string column."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    targets = set(subset or strings) & set(strings)
    tok = list(tokens)
    out = []
    for f in df.schema.fields:
        c = F.col(q(f.name))
        if f.name in targets and tok:
            out.append(F.when(~c.isin(tok), c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def numeric_text(df: DataFrame) -> DataFrame:
    """Cast the text columns all of whose values are numbers (whole numbers to bigint, others
    to double), decided by one aggregate over the rows; columns without a value stay text."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    aggs = []
    for i, c in enumerate(texts):
        x = F.col(q(c))
        whole = trim_ws(x).rlike(r"^[+-]?[0-9]{1,18}$")
        aggs += [F.count(x).alias(f"n{i}"), F.count(numeric_or_null(x)).alias(f"num{i}"), F.count_if(whole).alias(f"int{i}")]
    row = df.agg(*aggs).first()
    kind = {c: "bigint" if row[f"int{i}"] == row[f"n{i}"] else "double" for i, c in enumerate(texts)
            if row[f"n{i}"] and row[f"num{i}"] == row[f"n{i}"]}
    return df.select(*[(trim_ws(F.col(q(f.name))).cast("bigint") if kind.get(f.name) == "bigint" else numeric_or_null(F.col(q(f.name)))
                        ).alias(f.name, metadata=f.metadata) if f.name in kind else F.col(q(f.name)) for f in df.schema.fields])


BAD_LINE = "__bad_line"


class MalformedCsv(ValueError):
    """A CSV has lines of a wrong width or values that its schema does not take."""


def _csv_texts(spark: SparkSession, path: str, sep: str, encoding: str, tokens) -> DataFrame:
    """The file as text columns under its header's names, with BAD_LINE: the line, where its
    width is not the header's (such a line's columns are padded or cut)."""
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, BAD_LINE]])
    raw = (reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
           .option("columnPruning", False).option("enforceSchema", True).csv(path))
    return rename_safe(null_tokens(raw, tokens, names))


def _typed(texts: DataFrame, schema: T.StructType) -> list[tuple]:
    """(field, text, value) per field of the schema; fields and columns match by position."""
    names = [c for c in texts.columns if c != BAD_LINE]
    if len(names) != len(schema.fields):
        raise MalformedCsv(f"the header has {len(names)} columns, the schema {len(schema.fields)}")
    out = []
    for f, c in zip(schema.fields, names):
        x = F.col(q(c))
        text = x if isinstance(f.dataType, T.StringType) else trim_ws(x)
        out.append((f, x, text.try_cast(f.dataType)))
    return out


def _as_schema(schema) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def csv_report(spark: SparkSession, path: str, *, sep: str = ",", encoding: str = "utf-8", schema: T.StructType | str | None = None,
               tokens=STRICT_NULL_TOKENS) -> DataFrame:
    """(kind, column, n, example): what is wrong with a CSV, from one pass. ``width`` counts the
    lines with more or fewer values than the header, ``cast`` the values of a column that the
    schema's type does not take (lines of a wrong width aside); no rows for a clean file."""
    texts = _csv_texts(spark, path, sep, encoding, tokens)
    line = F.col(BAD_LINE)
    # the reader refuses a query of the bad lines alone: name a column beside them
    first = F.col(q(texts.columns[0]))
    parts = [F.struct(F.lit("width").alias("kind"), F.lit(None).cast("string").alias("column"), F.coalesce(line, first).alias("example"),
                      line.isNotNull().alias("bad"))]
    for f, x, value in _typed(texts, _as_schema(schema)) if schema is not None else ():
        parts.append(F.struct(F.lit("cast").alias("kind"), F.lit(f.name).alias("column"), x.alias("example"),
                              (line.isNull() & x.isNotNull() & value.isNull()).alias("bad")))
    return (texts.select(F.inline(F.array(*parts))).where("bad").groupBy("kind", "column")
            .agg(F.count(F.lit(1)).alias("n"), F.min("example").alias("example")))


def read_csv(spark: SparkSession, path: str, *, sep: str = ",", encoding: str = "utf-8",
             schema: T.StructType | str | None = None, tokens=STRICT_NULL_TOKENS,
             infer: bool = True, mode: str = "strict") -> DataFrame:
    """Headered CSV: optional explicit schema (its fields by position), dots in names replaced,
    marker tokens and NaN turned into NULL. Without a schema the file is read as text, the markers
    become NULL, and columns that then hold numbers only become numeric (``infer=False`` keeps
    text), so a marker never decides a column's type.

    ``mode`` says what happens to lines of a wrong width and values that the schema does not take:
    ``strict`` counts them in one pass first and raises :class:`MalformedCsv` with the counts and
    examples, ``failfast`` raises at the first one when the frame is used (no pass), ``drop``
    leaves such lines out and ``permissive`` pads, cuts and turns them into NULL; after either of
    these, :func:`csv_report` says what there was."""
    if mode not in ("strict", "failfast", "drop", "permissive"):
        raise ValueError(f"unknown mode {mode}")
    texts = _csv_texts(spark, path, sep, encoding, tokens)
    if mode == "strict":
        wrong = csv_report(spark, path, sep=sep, encoding=encoding, schema=schema, tokens=tokens).collect()
        if wrong:
            what = [f"{r['n']} lines of a wrong width, such as {r['example']!r}" if r["kind"] == "width" else
                    f"{r['n']} values of {r['column']}, such as {r['example']!r}" for r in sorted(wrong, key=lambda r: (r["kind"], r["column"] or ""))]
            raise MalformedCsv(f"{path}: " + "; ".join(what))
    line, names = F.col(BAD_LINE), [c for c in texts.columns if c != BAD_LINE]
    if schema is None:
        typed, bad = [F.col(q(c)).alias(c, metadata=texts.schema[c].metadata) for c in names], line.isNotNull()
    else:
        fields = _typed(texts, _as_schema(schema))
        typed = [v.alias(safe_name(f.name), metadata={"source_name": f.name}) for f, _, v in fields]
        bad = line.isNotNull()
        for _, x, v in fields:
            bad = bad | (x.isNotNull() & v.isNull())
    if mode == "drop":
        texts = texts.where(~bad)
    elif mode == "failfast":
        texts = texts.where(F.when(bad, F.raise_error(F.concat(F.lit("malformed line: "), F.coalesce(line, F.lit("value of a wrong type")))).cast("boolean"))
                            .otherwise(F.lit(True)))
    df = nulls_for_nan(texts.select(*typed))
    return numeric_text(df) if schema is None and infer else df


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Write a directory of part files (parquet default; csv gets a header)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
