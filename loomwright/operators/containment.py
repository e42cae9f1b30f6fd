"""Which of a set of quotes occur in which texts: one automaton over the quotes, one pass over the texts.

The quotes are a stated query set. Their size is measured first; up to ``BLOCK_BYTES`` they are one automaton,
beyond that they are dealt by a hash into blocks, each of which is collected, broadcast and scanned in turn. Texts
are not compared with quotes one by one, so the time is that of reading the texts, whatever the number of quotes.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loomwright.session import ship_package, written

#: Bytes of quotes in one automaton, which takes some 50 times as much memory.
BLOCK_BYTES = 4_000_000
_BUILT: dict[int, object] = {}


def automaton_of(shared):
    """The automaton of a broadcast block, built once in a worker: a match gives (length, hash) of a quote."""
    import ahocorasick

    if shared.id not in _BUILT:
        _BUILT.clear()  # one block at a time
        found = ahocorasick.Automaton()
        for quote, h in shared.value:
            if quote:
                found.add_word(quote, (len(quote), h))
        if len(found):
            found.make_automaton()
        _BUILT[shared.id] = found
    return _BUILT[shared.id]


class _Block:
    """A broadcast block with an id that Python workers see."""

    def __init__(self, broadcast) -> None:
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    def __getstate__(self) -> dict:
        return {"broadcast": self.broadcast, "id": self.id}

    @property
    def value(self):
        return self.broadcast.value


def quote_blocks(distinct: DataFrame) -> list[_Block]:
    """Stored rows (_q, _quote) as broadcast blocks of ``BLOCK_BYTES`` or so (one at least)."""
    size = distinct.agg(F.sum(F.octet_length("_quote") + 16)).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    parts = [distinct if blocks == 1 else distinct.where(F.pmod("_q", F.lit(blocks)) == b) for b in range(blocks)]
    return [_Block(distinct.sparkSession.sparkContext.broadcast([(r["_quote"], r["_q"]) for r in rows.collect()])) for rows in parts]


def held_quotes(texts: DataFrame, keys: list[str], text: str, quotes: DataFrame, quote: str) -> DataFrame:
    """Rows (``keys``, the columns of ``quotes`` but the quote) for each text and each quote that occurs in it.

    Null texts hold nothing, null quotes occur nowhere; an empty quote is in every text. Rows of equal quotes are
    found each; rows of ``texts`` are judged each. Without texts or quotes the result is empty."""
    spark = texts.sparkSession
    ship_package(spark)
    others = [c for c in quotes.columns if c != quote]
    hashed = quotes.where(F.col(quote).isNotNull()).select(*others, F.xxhash64(quote).alias("_q"), F.col(quote).alias("_quote"))
    distinct = written(hashed.select("_q", "_quote").distinct(), "quotes")
    source = texts.select(*keys, F.col(text).alias("_text")).where("_text is not null")
    schema = StructType([*(source.schema[k] for k in keys), StructField("_q", LongType())])
    n = len(keys)

    def scan(block):
        def run(batches):
            found = automaton_of(block)
            always = [h for q, h in block.value if not q]
            for batch in batches:
                at, hits = [], []
                for i, s in enumerate(batch.column(n).to_pylist()):
                    got = [*always, *({h for _, (_, h) in found.iter(s)} if len(found) else ())]
                    at += [i] * len(got)
                    hits += got
                places = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(places) for k in range(n)), pa.array(hits, pa.int64())], [*keys, "_q"])

        return run

    parts = [source.mapInArrow(scan(block), schema) for block in quote_blocks(distinct)]
    return reduce(DataFrame.unionByName, parts).join(hashed.drop("_quote"), "_q").drop("_q")
