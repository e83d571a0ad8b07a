"""Bounded training samples and the split that learning goes by."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: rows are counted by label and by this many leading bits of their order hash
CELL_BITS = 14
_LOWEST = -(1 << 63)


def held_out(doc_id: str, parts: int = 5, part: int = 0) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text, modulo ``parts``, is ``part`` (a null id reads as the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts == part


def order_hash(*columns: str) -> Column:
    return F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def _cell(order: str) -> Column:
    """The leading bits of a hash, in the order of the hashes."""
    return F.shiftrightunsigned(F.col(order).bitwiseXOR(F.lit(_LOWEST)), 64 - CELL_BITS)


def _bounds(ordered: DataFrame, per_label: int) -> dict:
    """For each label the largest of its ``per_label`` smallest orders; None where there are no more.

    Rows are counted by label and cell, in partial sums before the shuffle; only those counts come to the
    driver. Inside the cell in which a label's bound lies its different orders are counted instead, so an
    order with a third of all rows takes one place; if the bound lies further on, the next cell is looked into.
    """
    counts: dict = defaultdict(dict)
    for r in ordered.groupBy("label", _cell("order").alias("cell")).count().collect():
        counts[r["label"]][r["cell"]] = r["count"]
    bounds = dict.fromkeys(counts)
    looked: set = set()
    while True:
        crossed = {}
        for label, cells in counts.items():
            total = 0
            for cell in sorted(cells) if bounds[label] is None else ():
                if total + cells[cell] > per_label and (label, cell) not in looked:
                    crossed[label] = (cell, per_label - total)
                    break
                total += cells[cell]
                if total >= per_label:
                    bounds[label] = ((cell + 1) << (64 - CELL_BITS)) - 1 + _LOWEST
                    break
        if not crossed:
            return bounds
        spark = ordered.sparkSession
        rooms = spark.createDataFrame([(k, c, room) for k, (c, room) in crossed.items()], f"label {ordered.schema['label'].dataType.simpleString()}, cell long, room int")
        inside = ordered.withColumn("cell", _cell("order")).join(F.broadcast(rooms), ["label", "cell"]).select("label", "order", "room").distinct()
        first = inside.withColumn("at", F.row_number().over(Window.partitionBy("label").orderBy("order"))).where(f"at <= {per_label} AND at <= room")
        found = defaultdict(list)
        for r in first.collect():
            found[r["label"]].append(r["order"])
        for label, (cell, room) in crossed.items():
            looked.add((label, cell))
            counts[label][cell] = len(found[label])
            if len(found[label]) == room:
                bounds[label] = max(found[label])


def _smallest(rows: DataFrame, label: Column, order: Column, per_label: int) -> Column:
    """A filter for the ``per_label`` rows of each label that come first by ``order``; rows that tie there stay."""
    ordered = rows.select(label.alias("label"), order.alias("order")).where("label IS NOT NULL")
    bounds = _bounds(ordered, per_label)
    kept = F.lit(False)
    for name in sorted(bounds, key=str):
        kept = kept | ((label == name) & (F.lit(True) if bounds[name] is None else order <= bounds[name]))
    return label.isNotNull() & kept


def smallest(rows: DataFrame, label: str, order: Column, per_label: int) -> DataFrame:
    return rows.where(_smallest(rows, F.col(label), order, per_label))


def bounded(rows: DataFrame, doc_id: str, label: str, per_label: int, learns: Column | None = None) -> Column:
    """A filter that keeps, of the rows to learn from, those of each label with the smallest hash of the id."""
    learns = ~held_out(doc_id) if learns is None else learns
    return learns & _smallest(rows.where(learns), F.col(label), order_hash(doc_id), per_label)


def different(rows: DataFrame, label: str, id_: str, text: str, per_label: int) -> DataFrame:
    """The different rows ``(label, id, text)``, of each label at most ``per_label``: those of smallest hash.

    This bounds what a repeated id brings: equal rows become one before they are counted.
    """
    own = rows.select(label, id_, text).distinct().withColumn("hash", order_hash(id_, text))
    return smallest(own, label, F.col("hash"), per_label)
