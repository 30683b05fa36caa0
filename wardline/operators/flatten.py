"""P10: documents flattened to one column a path, with no schema given.

The paths come from the documents: Spark's XML reader infers a schema for each partition's
rows in its task and merges the schemas (an element that repeats in any document is an
array, one with attributes or children in any document a struct), so what reaches the
driver is one schema, however many documents there are. All leaves are text: a VARIANT or
typed inference would read 007 as 7. The documents are then parsed with that schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wardline.functions.xmlmsg import CORRUPT, leaf_paths

#: Names of an attribute (before its own name) and of an element's text beside attributes or children.
ATTRIBUTE, TEXT = "@", "#text"
_OPTIONS = {"rowTag": "doc", "inferSchema": "false", "attributePrefix": ATTRIBUTE, "valueTag": TEXT, "columnNameOfCorruptRecord": CORRUPT}


def _rooted(text: Column) -> Column:
    """The document below a root of our own, so that its root's name is part of the paths."""
    return F.concat(F.lit("<doc>"), F.regexp_replace(text, r"^\s*<\?xml[^>]*\?>", ""), F.lit("</doc>"))


def discover(df: DataFrame, text: str = "text") -> StructType:
    """The merged schema of all documents; malformed ones add nothing."""
    spark = df.sparkSession
    docs = df.where(F.col(text).isNotNull()).select(_rooted(F.col(text)).alias("value"))
    strings = getattr(docs._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    found = DataFrame(spark.read.options(**_OPTIONS)._jreader.xml(strings), spark).schema
    return StructType([f for f in found.fields if f.name != CORRUPT])


def flatten_documents(df: DataFrame, text: str = "text", *keep: str, schema: StructType | None = None) -> DataFrame:
    """``keep`` and a column for each path of the documents: ``Root.Element.Leaf``, ``Root.Element.@attribute``.

    Of repeated elements the last that has the leaf wins; an element's text has the element's path,
    whether or not it has attributes; empty text is NULL; malformed and null documents give NULLs. Two
    ways to write one path (dots in names) are one column: the first that has a value.
    """
    schema = discover(df, text) if schema is None else schema
    if not schema.fields:
        return df.select(*keep)
    read = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = df.select(*keep, F.from_xml(_rooted(F.col(text)), read, _OPTIONS).alias("_doc"))
    names: dict[str, list[str]] = {}
    leaves = leaf_paths(schema)
    cells = parsed.select(*keep, *[leaf(F.col("_doc")).alias(f"_{i}") for i, (_, leaf) in enumerate(leaves)])
    for i, (path, _) in enumerate(leaves):
        names.setdefault(path.removesuffix(f".{TEXT}"), []).append(f"_{i}")
    return cells.select(*keep, *[F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in held]).alias(path) for path, held in names.items()])
