"""What holds at the top of each page, by a prefix scan over pages: no document is walked from its beginning.

The state is a year and a type. What a page does to it is a map over the few types and the years that its lines name: for (type, year) the
type and year after the page. Maps of consecutive pages are composed block by block, levels of blocks as long as a document has several,
and the state at each document's beginning is then handed down through the blocks to the pages.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..schemas import DIVIDEND_TYPES
from ..sources.stored import stored

#: Pages, or blocks, of a document that one task composes at a time.
FAN = 512
KINDS = (None, *DIVIDEND_TYPES)

State = tuple[str, str | None]
#: From (type, year) to (type, year). As a key, None stands for every year without a key; as a value for the year as it came.
Map = dict[tuple[str | None, str | None], tuple[str | None, str | None]]

MAP = "array<struct<kind:string,year:string,to_kind:string,to_year:string>>"
NODE = f"doc_id {{0}}, at long, map {MAP}"


def after(m: Map, state: State) -> State:
    year, kind = state
    if not m:
        return state
    to_kind, to_year = m[kind, year if (kind, year) in m else None]
    return (year if to_year is None else to_year), to_kind


def as_map(follow: Callable[[State], State], years: set[str]) -> Map:
    """follow as a map, given the years that it tells from others."""
    other, out = "\0", {}
    for kind in KINDS:
        for year in (None, *sorted(years)):
            to_year, to_kind = follow((other if year is None else year, kind))
            out[kind, year] = to_kind, None if to_year == other else to_year
    return {} if all(value == key for key, value in out.items()) else out


def compose(first: Map, second: Map) -> Map:
    """first, then second."""
    if not first or not second:
        return first or second
    return as_map(lambda state: after(second, after(first, state)), {y for m in (first, second) for _, y in m if y is not None})


def packed(m: Map) -> list[dict]:
    return [{"kind": k, "year": y, "to_kind": a, "to_year": b} for (k, y), (a, b) in m.items()]


def unpacked(rows: list[dict] | None) -> Map:
    return {(r["kind"], r["year"]): (r["to_kind"], r["to_year"]) for r in rows or ()}


def stream(df: DataFrame, keys: list[str], order: list[str], handle: Callable[[Iterator[dict]], Iterator[dict]], schema: str | T.StructType) -> DataFrame:
    """handle gets the rows of one group in order, as they come from the sort, and yields rows; a task holds a batch of either."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches):
        rows = (r for b in batches for r in b.to_pylist())
        out = (x for _, group in groupby(rows, key=lambda r: [r[k] for k in keys]) for x in handle(group))
        while part := list(islice(out, 4096)):
            yield pa.RecordBatch.from_pylist(part, schema=arrow)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def states_at(nodes: DataFrame, first: DataFrame) -> DataFrame:
    """doc_id, at, year, kind at the beginning of each node. nodes: doc_id, at (a whole number from 0, its place), map; first: doc_id, year, kind at
    the document's beginning. Nodes are read once a level of blocks; documents without a first state are left out."""
    levels, last = 0, nodes.agg(F.max("at")).first()[0] or 0
    while last >= FAN ** (levels + 1):
        levels += 1
    return _states(nodes, first, levels)


def _states(nodes: DataFrame, first: DataFrame, levels: int) -> DataFrame:
    kind = nodes.schema["doc_id"].dataType.simpleString()

    def composed(rows: Iterator[dict]) -> Iterator[dict]:
        whole: Map = {}
        for r in rows:
            whole = compose(whole, unpacked(r["map"]))
        yield {"doc_id": r["doc_id"], "at": r["block"], "map": packed(whole)}

    def handed_down(rows: Iterator[dict]) -> Iterator[dict]:
        state = None
        for r in rows:
            if r["at"] is None:
                state = r["year"], r["kind"]
            elif state is not None:
                yield {"doc_id": r["doc_id"], "at": r["at"], "year": state[0], "kind": state[1]}
                state = after(unpacked(r["map"]), state)

    nodes = nodes.select("doc_id", "at", "map", F.floor(F.col("at") / FAN).alias("block")) if levels else nodes.select("doc_id", "at", "map", F.lit(0).cast("long").alias("block"))
    if levels:
        nodes = stored(nodes, "nodes")
        first = _states(stream(nodes, ["doc_id", "block"], ["at"], composed, NODE.format(kind)), first, levels - 1).withColumnRenamed("at", "block")
    else:
        first = first.withColumn("block", F.lit(0).cast("long"))
    # The state of a block goes before its nodes: nulls come first.
    rows = nodes.unionByName(first.select("doc_id", "block", "year", "kind"), allowMissingColumns=True)
    return stream(rows, ["doc_id", "block"], ["at"], handed_down, f"doc_id {kind}, at long, year string, kind string")
