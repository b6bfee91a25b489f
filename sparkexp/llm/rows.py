"""Row-local work in Arrow batches, and the shared reading of words."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

# Rows that Python holds at once, so that long texts stay bounded.
ROWS_AT_ONCE = 256
# A-Z in lower case; ASCII that is neither a letter nor a digit becomes a space.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)

# Lists of input values by column in, lists of added values by column out.
BatchFunction = Callable[[list[list]], list[list]]


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of letters, digits and non-ASCII characters; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def position_of(df: DataFrame, name: str) -> int:
    """Index of the column called exactly ``name``, whatever other columns are called."""
    try:
        return df.columns.index(name)
    except ValueError:
        raise ValueError(f"There is no column {name!r} among {df.columns}.") from None


def add_columns(
    df: DataFrame,
    uses: Sequence[str],
    added: Sequence[StructField],
    make: Callable[[], BatchFunction],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add columns computed row by row from the columns in ``uses``.

    ``make`` runs once a task and returns the function for a batch: it gets a
    list for each used column and returns a list for each added one. ``keep``
    names the input columns that stay (default: all). An input column whose
    name equals that of an added one, in any case, is replaced. No shuffle.
    """
    taken = {field.name.lower() for field in added}
    kept = [
        (i, field)
        for i, field in enumerate(df.schema.fields)
        if (keep is None or field.name in keep) and field.name.lower() not in taken
    ]
    used = [position_of(df, name) for name in uses]
    needed = sorted({i for i, _ in kept} | set(used))
    schema = StructType([StructField(f.name, f.dataType, True) for _, f in kept] + list(added))
    arrow, places = to_arrow_schema(schema), {i: k for k, i in enumerate(needed)}
    kept_at, used_at = [places[i] for i, _ in kept], [places[i] for i in used]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                new = function([part.column(i).to_pylist() for i in used_at])
                columns = [part.column(i) for i in kept_at]
                columns += [pa.array(v, arrow.field(len(kept_at) + k).type) for k, v in enumerate(new)]
                columns = [c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    renamed = df.toDF(*[f"_{i}" for i in range(len(df.columns))]).select(*[f"_{i}" for i in needed])
    return renamed.mapInArrow(run, schema)
