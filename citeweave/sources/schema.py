"""Publication record schema.

The record layout is fixed by the input format (one JSON object per line).
Only ``id``, ``title``, ``outCitations`` and ``journalName`` feed the graph;
the other fields are declared so that strict parsing accepts real records,
and are pruned by the JSON reader whenever a query does not select them.
"""

from pyspark.sql import types as T

# Field names and types of a publication record, in record order.
AUTHOR = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("ids", T.ArrayType(T.StringType())),
])

PUBLICATION = T.StructType([
    T.StructField("entities", T.ArrayType(T.StringType())),
    T.StructField("journalVolume", T.StringType()),
    T.StructField("journalPages", T.StringType()),
    T.StructField("pmid", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("outCitations", T.ArrayType(T.StringType())),
    T.StructField("s2Url", T.StringType()),
    T.StructField("s2PdfUrl", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("authors", T.ArrayType(AUTHOR)),
    T.StructField("journalName", T.StringType()),
    T.StructField("paperAbstract", T.StringType()),
    T.StructField("inCitations", T.ArrayType(T.StringType())),
    T.StructField("pdfUrls", T.ArrayType(T.StringType())),
    T.StructField("title", T.StringType()),
    T.StructField("doi", T.StringType()),
    T.StructField("sources", T.ArrayType(T.StringType())),
    T.StructField("doiUrl", T.StringType()),
    T.StructField("venue", T.StringType()),
])

# The columns the graph operators read.
GRAPH_COLUMNS = ["id", "title", "journalName", "outCitations"]

CORRUPT_COLUMN = "_corrupt_record"


def with_corrupt_column(schema: T.StructType = PUBLICATION) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
