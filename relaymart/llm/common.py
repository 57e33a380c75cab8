"""Shared pieces of the corpus operators: words, table reading, written
intermediates and pass-through of record batches."""

from __future__ import annotations

import functools
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaymart.session import work_path
from relaymart.sinks import files

#: Bytes of a word (after A-Z are lowered): digits, a-z, every non-ASCII byte.
#: On UTF-8 bytes this equals the code point class [^\x00-\x2F\x3A-\x60\x7B-\x7F].
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """The lower-cased words of a text as UTF-8 bytes; null has none."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def word_spans(text: str) -> tuple[bytes, list[tuple[int, int]]]:
    """The text's UTF-8 bytes and the byte range of each of its words."""
    raw = text.encode("utf-8", "surrogatepass")
    return raw, [m.span() for m in WORD.finditer(raw.lower())]


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per Spark application."""
    context = spark.sparkContext
    if getattr(context, "_relaymart_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="relaymart-code-")) / "relaymart.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted((root / "relaymart").rglob("*.py")):
            z.write(f, f.relative_to(root))
    context.addPyFile(str(archive))
    context._relaymart_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate to the cluster's shared folder and read it back:
    lineage ends there, so a lost executor costs no recomputation of it."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.relaymart_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Remove tables of :func:`written` that nothing reads any more."""
    for df in tables:
        files.remove(df.sparkSession, df.relaymart_path)


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null for a null id)."""
    return F.crc32(doc_id.cast("string")) % F.lit(mod)


def map_frames(df: DataFrame, key: str, fn: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """``mapInPandas`` with the nullable long column ``key`` carried as text: pandas
    makes floats of longs beside nulls, which are exact below 2^53 only."""
    made = df.withColumn(key, F.col(key).cast("long").cast("string")).mapInPandas(fn, schema.replace(f"{key} long", f"{key} string"))
    return made.withColumn(key, F.col(key).cast("long"))


def map_texts(df: DataFrame, column: str, fn: Callable[[], Callable[[list], list]], added: str = "") -> DataFrame:
    """Stream record batches through ``fn()(texts)`` and keep all other columns.

    ``fn`` is called once per task and gives a function of a batch's texts. For
    each text that returns None to drop the row, or (new text, values of the
    ``added`` columns...). The schema is the input's, then the ``added`` DDL
    columns. Batches are bounded in bytes by Spark; no state outlives one.
    """
    from pyspark.sql.types import StructType

    schema = StructType(list(df.schema.fields))
    extra = StructType.fromDDL(added) if added else StructType([])
    for f in extra.fields:
        schema = schema.add(f)
    position = df.columns.index(column)
    arrow_extra = _arrow_types(extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_texts = fn()
        for batch in batches:
            results = of_texts(batch.column(position).to_pylist())
            keep = pa.array([r is not None for r in results], pa.bool_())
            results = [r for r in results if r is not None]
            kept = batch.filter(keep)
            columns = list(kept.columns)
            columns[position] = pa.array([r[0] for r in results], columns[position].type)
            columns += [pa.array([r[i + 1] for r in results], t) for i, t in enumerate(arrow_extra)]
            names = [*batch.schema.names, *extra.names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, schema)


def map_text(df: DataFrame, column: str, fn: Callable[[], Callable[[str | None], tuple | None]],
             added: str = "") -> DataFrame:
    """:func:`map_texts` with a function of one text."""

    def of_batch():
        one = fn()
        return lambda texts: [one(t) for t in texts]

    return map_texts(df, column, of_batch, added)


def _arrow_types(schema) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in schema.fields]


@functools.lru_cache(maxsize=1)
def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where an installed public tokenizer file lies (on the calling machine)."""
    import public_tokenizers

    return public_tokenizers.path(name)
