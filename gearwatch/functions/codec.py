"""JSON message codec: binary topic value <-> typed columns."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def decode(
    df: DataFrame,
    schema: StructType,
    value_col: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Decode a JSON ``value`` (binary or string) into the columns of ``schema``.

    Permissive: a malformed message, JSON ``null``, an array, an empty or NULL
    value all give a row whose fields are NULL; a field whose value does not fit
    its type is NULL on its own.  Rows are never dropped.  ``keep`` passes other
    source columns (e.g. the topic ``timestamp``) through unchanged.
    """
    # inline() is a generator: the optimizer keeps filters and projections above it, so a
    # message is parsed once however many of its fields they read
    message = F.from_json(F.col(value_col).cast("string"), schema)
    return df.select(*keep, F.inline(F.array(message)))


def encode(
    df: DataFrame,
    columns: Sequence[str],
    key: str | None = None,
    as_binary: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Pack ``columns`` (in this order) into one JSON text column ``value``.

    NULL fields are left out of the text; decoding with the same schema reads
    them back as NULL, so the round trip is lossless.  With ``key`` the result
    also has a ``key`` column holding that column's text, as a keyed producer
    would send it.  ``keep`` passes other columns through beside the record (to sort it by, say).
    """
    value = F.to_json(F.struct(*[F.col(c) for c in columns]))
    if as_binary:
        value = value.cast("binary")
    out = [value.alias("value")]
    if key is not None:
        k = F.col(key).cast("string")
        out.insert(0, (k.cast("binary") if as_binary else k).alias("key"))
    return df.select(*out, *keep)


def decode_checked(
    df: DataFrame,
    schema: StructType,
    value_col: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``decode`` that also says which messages are damaged: ``damaged`` (boolean, never NULL) and ``text``, the
    message as it came where it is damaged (else NULL; NULL too if the message itself is).

    Damaged is what has no record (empty, blank or NULL value, JSON ``null``, an array, a bare value), is no JSON, or
    has a field that does not fit its type; its row holds the fields that could be read, as ``decode`` gives them.  A
    field that is missing or ``null`` and a field that the schema does not name are no damage, nor is what follows a whole
    record.  The same parse yields both.
    """
    taken = {f.name.lower() for f in schema.fields}
    corrupt = next(name for name in ("_corrupt", "_corrupt_record", *(f"_corrupt{i}" for i in range(len(taken))))
                   if name.lower() not in taken)
    text = F.col(value_col).cast("string")
    message = F.from_json(text, StructType([*schema.fields]).add(corrupt, "string"), {"columnNameOfCorruptRecord": corrupt})
    # a NULL struct (no record) is told from a record without fields before inline() makes both rows of NULLs
    parsed = df.select(*keep, text.alias("__text"), F.inline(F.array(
        F.struct(message.alias("__message")))))
    damaged = F.col("__message").isNull() | F.col(f"__message.{corrupt}").isNotNull()
    return parsed.select(*keep, *(F.col(f"__message.{f.name}").alias(f.name) for f in schema.fields),
                         damaged.alias("damaged"), F.when(damaged, F.col("__text")).alias("text"))
