"""Schemas that drift between the files of a series.

Each payload is parsed once into a map of tagged values (JSON variants). Per file these fuse, by an
associative aggregate, into a tagged union: field -> set of the JSON types of its values. Files of a
series are compared in order; a lost and a new field are the same one if the records that both files
deliver bear it out. A fold over the unions of a series follows every field through its renames and
reports the alternatives as they appear. Values meet only per record, so a series may be of any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorloom.functions.common import broadcast_if_small, cut_lineage

# The JSON types and their bits in a set of types.
TYPE_BITS = {"string": 1, "number": 2, "boolean": 4, "array": 8, "object": 16}
FOLD = "dataset string, shard long, seq long, file_name string, change string, old_field string, new_field string, old_types int, new_types int, canonical string"


def _type_bit(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | F.is_variant_null(v), 0)
        .when(kind == "STRING", TYPE_BITS["string"])
        .when(kind == "BOOLEAN", TYPE_BITS["boolean"])
        .when(kind.startswith("ARRAY"), TYPE_BITS["array"])
        .when(kind.startswith("OBJECT"), TYPE_BITS["object"])
        .otherwise(TYPE_BITS["number"])
    )


def _canonical_value(v: Column) -> Column:
    """A text that is equal for equal JSON values: 1 and 1.0 are one number, keys have no order."""
    number = F.try_variant_get(v, "$", "double")
    exact = F.when(F.abs(number) < 2**53, number.cast("string")).otherwise(F.to_json(v))
    return F.when(_type_bit(v) == TYPE_BITS["number"], exact).otherwise(F.to_json(v))


def parse_lines(raw: DataFrame) -> DataFrame:
    """dataset, shard, seq, file_name, line_no, record_key, payload and fields (map of variants).

    A payload that is no JSON object (or null) has null fields.
    """
    return raw.select(
        "dataset",
        F.col("shard").cast("long").alias("shard"),
        F.col("file_seq").cast("long").alias("seq"),
        "file_name",
        "line_no",
        "record_key",
        "payload",
        F.try_parse_json("payload").try_cast("map<string,variant>").alias("fields"),
    ).filter(F.col("dataset").isNotNull() & F.col("shard").isNotNull() & F.col("seq").isNotNull())


def _unions(lines: DataFrame) -> DataFrame:
    """One row per file: its tagged union as an array of (field, types), and the file before it."""
    tagged = lines.select("dataset", "shard", "seq", "file_name", F.explode_outer(F.map_entries("fields")).alias("e"))
    per_field = tagged.groupBy("dataset", "shard", "seq", F.col("e.key").alias("field")).agg(
        F.bit_or(_type_bit(F.col("e.value"))).cast("int").alias("types"), F.max("file_name").alias("file_name")
    )
    per_file = per_field.groupBy("dataset", "shard", "seq").agg(
        F.max("file_name").alias("file_name"),
        F.sort_array(F.collect_list(F.when(F.col("field").isNotNull(), F.struct("field", "types")))).alias("fields"),
    )
    w = Window.partitionBy("dataset", "shard").orderBy("seq")
    names, before = F.col("fields.field"), F.lag("fields").over(w)
    return per_file.select(
        "*", F.lag("seq").over(w).alias("seq_before"), F.array_except(before["field"], names).alias("gone"), F.array_except(names, before["field"]).alias("came")
    )


def _renames(lines: DataFrame, unions: DataFrame) -> DataFrame:
    """dataset, shard, seq and renames: the pairs of a lost and a new field that are one."""
    steps = unions.filter((F.size("gone") > 0) & (F.size("came") > 0))
    role = lambda seq, names, side: steps.select("dataset", "shard", F.col(seq).alias("seq"), F.col("seq").alias("step"), F.col(names).alias("names"), F.lit(side).alias("side"))
    roles = broadcast_if_small(role("seq_before", "gone", "old").unionByName(role("seq", "came", "new")))
    own = F.filter(F.map_entries(F.map_filter("fields", lambda k, v: F.array_contains("names", k))), lambda e: _type_bit(e["value"]) > 0)
    values = F.transform(own, lambda e: F.struct(e["key"].alias("field"), _canonical_value(e["value"]).alias("value")))
    held = (
        lines.filter("record_key is not null")
        .join(roles, ["dataset", "shard", "seq"])
        .select("dataset", "shard", "step", "record_key", "side", F.explode(values).alias("v"))
        .groupBy("dataset", "shard", "step", "record_key")
        .agg(*[F.collect_set(F.when(F.col("side") == s, F.col("v"))).alias(s) for s in ("old", "new")])
    )
    pairs = held.withColumn("o", F.explode("old")).withColumn("n", F.explode("new"))
    borne_out = (
        pairs.groupBy("dataset", "shard", "step", F.col("o.field").alias("old"), F.col("n.field").alias("new"))
        .agg(F.bool_and(F.col("o.value") == F.col("n.value")).alias("same"))
        .filter("same")
    )
    return borne_out.groupBy("dataset", "shard", F.col("step").alias("seq")).agg(F.sort_array(F.collect_list(F.struct("old", "new"))).alias("renames"))


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Follows each series' fields; rows come sorted by series and file."""
    series, types, root = None, {}, {}
    for batch in batches:
        out = []
        for f in batch.itertuples(index=False):
            now = {x["field"]: x["types"] for x in f.fields}
            first = series != (f.dataset, f.shard)
            if first:
                series, types, root = (f.dataset, f.shard), {}, {}
            renames = [] if first or f.renames is None else [(x["old"], x["new"]) for x in f.renames]
            emit = lambda change, old, new, a, b: out.append((f.dataset, f.shard, f.seq, f.file_name, change, old, new, a, b, None))  # noqa: B023, E731
            if not first:
                moved_from, moved_to = {o for o, _ in renames}, {n for _, n in renames}
                for o, n in renames:
                    emit("renamed", o, n, types[o], now[n])
                for o in types:
                    if o not in now and o not in moved_from:
                        emit("removed", o, "", types[o], 0)
                for n in now:
                    if n not in types and n not in moved_to:
                        emit("added", "", n, 0, now[n])
            next_types, next_root = {}, {}
            for n, bits in now.items():
                before = [n] if n in types else sorted(o for o, m in renames if m == n)
                for o in before:
                    if bits and types[o] and bits != types[o]:
                        emit("type_changed", o, n, types[o], bits)
                next_types[n] = bits or next((types[o] for o in before if types[o]), 0)
                if before:
                    next_root[n] = root[before[0]]
            taken = set(next_root.values())
            for n in now:
                if n not in next_root:
                    name, k = n, 1
                    while name in taken:
                        k += 1
                        name = f"{n}_{k}"
                    taken.add(name)
                    next_root[n] = name
                out.append((f.dataset, f.shard, f.seq, f.file_name, "field", n, n, 0, int(now[n]), next_root[n]))
            types, root = next_types, next_root
        yield pd.DataFrame(out, columns=[c.split()[0] for c in FOLD.split(", ")])


def schema_history(raw: DataFrame) -> DataFrame:
    """What became of every field of every file: see FOLD for the columns.

    raw has dataset, shard, file_seq, file_name, record_key and payload (a JSON object as text);
    (dataset, shard) is a series. change is 'renamed', 'added', 'removed' or 'type_changed' against
    the file before (none for a series' first file), or 'field' for each field present, with the
    canonical name it has in the consistent table: the one under which it was first added.
    old_types and new_types are sets of JSON types (TYPE_BITS).

    A payload that is null, no object or not readable delivers no field, but its file is a file.
    Copies of lines change nothing; records without a key can't bear out a rename; rows without
    dataset, shard or file_seq are left out. A field can be renamed to several, if all are borne out.
    """
    lines = parse_lines(raw)
    unions = cut_lineage(_unions(lines))  # one row per file
    files = unions.join(_renames(lines, unions), ["dataset", "shard", "seq"], "left")
    files = files.select("dataset", "shard", "seq", "file_name", "fields", "renames")
    files = files.repartition("dataset", "shard").sortWithinPartitions("dataset", "shard", "seq")
    return files.mapInPandas(_fold, FOLD)


def consistent_table(raw: DataFrame, dataset: str, history: DataFrame | None = None, most_columns: int = 1000) -> DataFrame:
    """All records of a dataset in one table: a row per file and distinct line.

    Columns: shard, file_seq, file_name, record_key, payload_ok, then each canonical field. A field
    with values of one JSON type has that type (array and object as JSON text). A field with several
    is split into typed branches name__string, name__number, ... and the column name holds the
    canonical conversion to text. Names that differ only in letter case get a number appended.
    Fields beyond the most_columns commonest stand as JSON text in the map other_fields. Unreadable
    payloads keep their row, with payload_ok false.
    """
    raw = raw.filter(F.col("dataset") == dataset)
    history = (schema_history(raw) if history is None else history).filter((F.col("dataset") == dataset) & (F.col("change") == "field"))
    history = cut_lineage(history.select("shard", "seq", "new_field", "canonical", "new_types"))
    fields = history.groupBy("canonical").agg(F.bit_or("new_types").alias("types"), F.count("*").alias("n")).orderBy(F.desc("n"), "canonical").limit(most_columns).collect()
    names = history.groupBy("shard", "seq").agg(F.map_from_entries(F.collect_list(F.struct("new_field", "canonical"))).alias("names"))
    lines = parse_lines(raw).dropDuplicates(["shard", "seq", "record_key", "payload"])
    lines = lines.join(broadcast_if_small(names), ["shard", "seq"], "left")
    lines = lines.withColumn("v", F.transform_keys("fields", lambda k, _: F.coalesce(F.element_at("names", k), k)))
    taken = {"shard", "file_seq", "file_name", "record_key", "payload_ok", "other_fields"}

    def free(name: str) -> str:
        k, out = 1, name
        while out.lower() in taken:
            k += 1
            out = f"{name}_{k}"
        taken.add(out.lower())
        return out

    as_type = {"string": "string", "number": "double", "boolean": "boolean"}
    columns = []
    for f in fields:
        v = F.element_at("v", F.lit(f.canonical))
        kinds = [t for t, bit in TYPE_BITS.items() if f.types & bit]
        typed = lambda t, v=v: F.when(_type_bit(v) == TYPE_BITS[t], F.try_variant_get(v, "$", as_type[t]) if t in as_type else F.to_json(v))
        if len(kinds) == 1:
            columns.append(typed(kinds[0]).alias(free(f.canonical)))
        else:
            text = F.when(_type_bit(v) == TYPE_BITS["string"], F.try_variant_get(v, "$", "string")).when(_type_bit(v) > 0, F.to_json(v))
            columns.append(text.alias(free(f.canonical)))
            columns += [typed(t).alias(free(f"{f.canonical}__{t}")) for t in kinds]
    known = [f.canonical for f in fields]
    other = F.transform_values(F.map_filter("v", lambda k, _: ~k.isin(known)), lambda _, v: F.to_json(v)) if known else F.transform_values("v", lambda _, v: F.to_json(v))
    return lines.select("shard", F.col("seq").alias("file_seq"), "file_name", "record_key", F.col("fields").isNotNull().alias("payload_ok"), *columns, other.alias("other_fields"))
