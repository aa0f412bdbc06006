"""Small tables with the awkward rows every operator has to stand, and plain versions of rules."""

import re
import zlib

from pyspark.sql import types as T

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i % 97} of{i % 13}" for i in range(30_000))
ROWS = [
    (1, "The cat and the dog sat on the mat, the end of the day.", "en", "b"),
    (2, None, "en", "a"),
    (3, "", None, "a"),
    (4, " \t\n ", "en", None),
    (5, "Der Hund und die Katze saßen auf der Matte.", "de", "b"),
    (5, "Der Hund und die Katze saßen auf der Matte.", "de", "b"),
    (6, LONG, "en", "b"),
    (7, "12345 !!! ???", "en", "a"),
    (8, "the cat AND the dog sat on the mat, the end of the day.", None, "c"),
    (9, "Le chien et le chat sont sur le tapis été naïve.", "fr", "b"),
    (10, "Le chien et le chat sont  sur\n\nle tapis. \U0001f600 <|endoftext|> don't", "fr", "b"),
    (None, "text without an id", "en", "b"),
    (11, "x", "en", "b"),
    (12, "one two", "en", "c"),
    (13, "Der Mann und die Frau gehen in das Haus, und der Tag ist lang.", "de", "a"),
]
# Names that operators use themselves.
CLASHING = ["row", "key", "size", "target", "copies", "part", "piece", "fp", "root", "place", "node", "label", "rare", "word", "rule"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in CLASHING])


def awkward(spark, rows=ROWS):
    full = [(*r, None if r[1] is None else len(r[1]), *["x"] * len(CLASHING)) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def crc(key):
    return zlib.crc32(str(key).encode())
