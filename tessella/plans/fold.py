"""Sequential folds over ordered groups of any size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def ordered_fold(df: DataFrame, keys: list[str], order: list[str], start: Callable[[], object], step: Callable[[object, dict], tuple[object, dict]], added: str, reads: list[str]) -> DataFrame:
    """`df` with the columns `added` (a schema) that `step` gives for each row, in `order` within `keys`.

    Some results depend on all rows before and cannot be written as window frames, like sums that start again or stacks.
    Rows are hash-partitioned by keys and sorted, and stream through one pass that keeps one state: memory doesn't grow
    with a group, and the sort spills. `start()` makes the state of a group; `step(state, row)` gives the next state and
    the added values; a row has the columns `reads` only, and no others become Python objects.
    """
    names = [x.strip().split(" ")[0].strip("`") for x in added.split(", ")]
    schema = StructType([*df.schema.fields, *StructType.fromDDL(added).fields])
    target = to_arrow_schema(schema)
    width = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            out: dict[str, list] = {n: [] for n in names}
            whose = zip(*(batch.column(k).to_pylist() for k in keys))
            for key, row in zip(whose, batch.select(reads).to_pylist()):
                if last is None or key != last:
                    last, state = key, start()
                state, values = step(state, row)
                for n in names:
                    out[n].append(values[n])
            columns = [*batch.columns, *(pa.array(out[n], target.field(width + k).type) for k, n in enumerate(names))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *names])

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
