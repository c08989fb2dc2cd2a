"""What several operators need: the tables, words, and work on whole texts."""

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from broadsheet.plans.bitfilter import bit_filter, maybe_in

WORD = r"[^\x20\x09-\x0D]+"
LAST_ID = 2**63 - 1  # stands for a null doc_id, which counts as the largest


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def without_losers(docs: DataFrame, keys: list[Column], verdict: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that lose by ``verdict``, with all their columns.

    ``verdict`` (columns ``__k0``, ``__k1`` ..., like ``keys``, and ``__stays``)
    names the keys that lose, and those of which one of several rows stays. A
    filter of these keys is tested where the rows are read. Rows it rules out
    pass straight through; only the others, the losers and few more, are
    shuffled to meet the verdict itself, which decides.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), *[k.alias(n) for k, n in zip(keys, names)])
    tested = maybe_in(whole, names, bit_filter(verdict, names), "__maybe")
    met = tested.where("__maybe").join(verdict, names, "left")
    out = tested.where("NOT __maybe").select("__doc").unionByName(met.where("__stays IS NULL").select("__doc"))
    if not verdict.where("__stays").isEmpty():
        out = out.unionByName(met.where("__stays").dropDuplicates(names).select("__doc"))
    return out.select("__doc.*")


PIECE_ROWS, PIECE_BYTES = 500, 4 << 20


def map_columns(
    frame: DataFrame,
    schema: str,
    rows: Callable[..., Iterable[tuple]],
    start: Callable[[], object] | None = None,
    most: int = PIECE_BYTES,
) -> DataFrame:
    """Run ``rows`` on the columns of ``frame``, a few rows at a time.

    ``rows`` gets one list for each column, after the result of ``start``
    (called once a task) if there is one, and yields result rows. It gets
    whole rows, up to 500 and to about ``most`` bytes at once, one at least.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = () if start is None else (start(),)
        for batch in batches:
            step = max(1, min(PIECE_ROWS, batch.num_rows * most // max(1, batch.nbytes)))
            for at in range(0, batch.num_rows, step):
                columns = [c.to_pylist() for c in batch.slice(at, step).columns]
                if out := list(rows(*first, *columns)):
                    arrays = [pa.array(c, f.type) for c, f in zip(zip(*out), arrow)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return frame.mapInArrow(run, schema)


def map_rows(
    frame: DataFrame, schema: str, row: Callable[..., Iterable[tuple]], start: Callable[[], object] | None = None
) -> DataFrame:
    """``map_columns`` with a function of one row's values."""

    def rows(*given):
        first, columns = (given[:1], given[1:]) if start else ((), given)
        for values in zip(*columns):
            yield from row(*first, *values)

    return map_columns(frame, schema, rows, start)
