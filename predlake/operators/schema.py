"""Infer, register, look up and enforce the logged-row schema.

The schema is dynamic (it comes from the payloads) but pinned once known:

* C1 ``infer_schema``: one distributed aggregation over the named inferences.
  Each side of an inference becomes one VARIANT object ``{column: [cells]}``;
  ``schema_of_variant_agg`` merges their types with a map-side partial
  aggregate, so only one small schema string per partition crosses the
  shuffle. Column order is the first inference's order (by occurred_at, id),
  then columns seen only later, by name. JSON numbers come back from VARIANT
  as DECIMAL, so every DECIMAL / FLOAT becomes DOUBLE and every integer BIGINT.
  A column whose cells differ in kind takes the kind of the first inference.
* C2 / C3 ``register`` / ``lookup``: a small catalog (subject, version, schema
  JSON), one file for each version. A version is created by a rename that fails where the
  version is there already, so of two writers one wins and the other takes the
  winner's schema. A registered schema is reused before inferring.
* ``evolve``: a batch's schema is joined with the registered one in a lattice of types
  (nothing < BIGINT < DOUBLE; lists and structs by their parts). A column that is new or
  wider makes the next version; one that has no common type keeps its own, and its
  cells of the other type are refused by C4.
* C4 ``enforce``: every datapoint is projected to the pinned schema with
  ``try_variant_get``; a non-null cell that does not cast gets a reason.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from predlake.functions.barrier import barrier
from predlake.functions.shared_files import create_once
from predlake.functions.times import format_iso


@dataclass
class PinnedSchema:
    """Ordered ``(name, spark type DDL)`` of the input and output columns."""

    inputs: list[tuple[str, str]] = field(default_factory=list)
    outputs: list[tuple[str, str]] = field(default_factory=list)
    version: int = field(default=0, compare=False)   # in the catalog; 0: not registered

    def to_json(self) -> str:
        return json.dumps({"inputs": self.inputs, "outputs": self.outputs})

    @staticmethod
    def from_json(text: str, version: int = 0) -> "PinnedSchema":
        d = json.loads(text)
        return PinnedSchema([tuple(x) for x in d["inputs"]], [tuple(x) for x in d["outputs"]], version)

    def layout(self) -> list[tuple[str, str, int, str]]:
        """Output columns as ``(name, side, index, type)``; a column that has only been null so far is text.

        Like ``{**inputs, **outputs}``: a name on both sides keeps the input's
        position and takes the output's value (B11).
        """
        out_idx = {n: (i, t) for i, (n, t) in enumerate(self.outputs)}
        cols = []
        for i, (n, t) in enumerate(self.inputs):
            if n in out_idx:
                j, tt = out_idx[n]
                cols.append((n, "out", j, tt))
            else:
                cols.append((n, "in", i, t))
        seen = {n for n, _ in self.inputs}
        for j, (n, t) in enumerate(self.outputs):
            if n not in seen:
                cols.append((n, "out", j, t))
        return [(n, side, i, _VOID.sub("string", t)) for n, side, i, t in cols]

    def struct_type(self) -> T.StructType:
        fields = [T.StructField("id", T.StringType()), T.StructField("occurred_at", T.StringType())]
        for n, _, _, t in self.layout():
            fields.append(T.StructField(n, T.DataType.fromDDL(t)))
        return T.StructType(fields)


# VARIANT type names -> the logged type (fixed mapping, see module doc).
LOGGED = {"DECIMAL": "double", "FLOAT": "double", "DOUBLE": "double", "TINYINT": "bigint", "SMALLINT": "bigint", "INT": "bigint",
          "BIGINT": "bigint", "VOID": "string", "VARIANT": "string", "TIMESTAMP_NTZ": "timestamp"}
EVOLVING = LOGGED | {"VOID": "void"}   # where a later batch may still tell the type
_VOID = re.compile(r"\bvoid\b")
_TOKEN = re.compile(r"\s*(?:`((?:[^`]|``)*)`|([^\s<>,:()`]+)|([<>,:()]))")


def _tokens(text: str) -> list[tuple[str, str]]:
    """("name" | "word" | "sign", text) of a type string; quoted names lose their quotes."""
    return [("name", m[1].replace("``", "`")) if m[1] is not None else ("word", m[2]) if m[2] else ("sign", m[3])
            for m in _TOKEN.finditer(text)]


def _parse(tokens: list[tuple[str, str]], at: int, logged: dict[str, str] = LOGGED) -> tuple[str, list[tuple[str, str]], int]:
    """(logged type, fields of an OBJECT, next token) of the type that begins at ``at``. Names never mix with types."""
    kind, at, fields = tokens[at][1], at + 1, []
    following = tokens[at] if at < len(tokens) else ("", "")
    if kind == "ARRAY" and following == ("sign", "<"):
        inner, _, at = _parse(tokens, at + 1, logged)
        return f"array<{inner}>", [], at + 1
    if kind == "OBJECT" and following == ("sign", "<"):
        at += 1
        while tokens[at] != ("sign", ">"):
            name = tokens[at][1]
            inner, _, at = _parse(tokens, at + 2, logged)
            fields.append((name, inner))
            at += tokens[at] == ("sign", ",")
        body = ", ".join(f"{_quoted(n)}: {t}" for n, t in fields)
        return (f"struct<{body}>" if fields else "string"), fields, at + 1
    if following == ("sign", "("):  # DECIMAL(p, s)
        while tokens[at] != ("sign", ")"):
            at += 1
        at += 1
    return logged.get(kind, kind.lower()), [], at


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def logged_type(variant_type: str) -> str:
    """Map a ``schema_of_variant`` type string to the column's Spark type."""
    return _parse(_tokens(variant_type), 0)[0]


def object_fields(variant_type: str | None, kinds: dict[str, str] = LOGGED) -> dict[str, str]:
    """Field -> logged element type of an object whose fields are arrays of cells; ``mixed`` where cells differ in kind."""
    if not variant_type or not variant_type.startswith("OBJECT<"):
        return {}
    tokens, at, out = _tokens(variant_type), 2, {}
    while tokens[at] != ("sign", ">"):
        name, start = tokens[at][1], at + 2
        logged, _, at = _parse(tokens, start, kinds)
        mixed = [t for _, t in tokens[start:at]] == ["ARRAY", "<", "VARIANT", ">"]
        out[name] = "mixed" if mixed else logged[len("array<"):-1] if logged.startswith("array<") else logged
        at += tokens[at] == ("sign", ",")
    return out


def _side_object(side: str) -> str:
    """``{column: [cells of that column]}`` as one VARIANT object per inference."""
    return (f"to_variant_object(map_from_arrays({side}.cols, "
            f"transform({side}.cols, (c, j) -> transform({side}.rows, r -> get(r, j)))))")


def infer_schema(named: DataFrame, kinds: dict[str, str] = LOGGED) -> PinnedSchema:
    """C1 over named inferences (rows with a reason are ignored).

    The ``_reason`` test sits inside the aggregates rather than in a ``where``:
    a filter would be pushed below the payload projection and inline (and so
    evaluate twice) the whole frame expression.
    """
    ok = F.col("_reason").isNull()
    order = F.when(ok, F.struct(F.col("occurred_at"), F.col("id")))
    agg = named.agg(
        F.min_by(F.when(ok, F.col("inputs.cols")), order).alias("in_first"),
        F.min_by(F.when(ok, F.col("outputs.cols")), order).alias("out_first"),
        F.expr(f"schema_of_variant_agg(IF(_reason IS NULL, {_side_object('inputs')}, NULL))").alias("in_types"),
        F.expr(f"schema_of_variant_agg(IF(_reason IS NULL, {_side_object('outputs')}, NULL))").alias("out_types"),
    ).collect()[0]
    sides = {"inputs": (agg.in_first, object_fields(agg.in_types, kinds)), "outputs": (agg.out_first, object_fields(agg.out_types, kinds))}
    mixed = [(side, n) for side, (_, types) in sides.items() for n, t in types.items() if t == "mixed"]
    firsts = _first_types(named, mixed) if mixed else {}
    return PinnedSchema(*(_side(side, first, types, firsts) for side, (first, types) in sides.items()))


def _first_types(named: DataFrame, mixed: list[tuple[str, str]]) -> dict[tuple[str, str], str]:
    """Types of columns whose cells differ in kind: that of the first inference with a typed cell, by time and position;
    an integer column is double if a fraction is seen anywhere. Cells of other kinds are refused by C4."""
    aggs = []
    for i, (side, name) in enumerate(mixed):
        cells = f"transform({side}.rows, r -> get(r, cast(array_position({side}.cols, {_sql_str(name)}) as int) - 1))"
        kinds = f"filter(transform({cells}, c -> schema_of_variant(c)), t -> t IS NOT NULL AND t <> 'VOID')"
        seen = F.expr(f"IF(_reason IS NULL AND array_contains({side}.cols, {_sql_str(name)}), {kinds}, NULL)")
        order = F.when(F.size(seen) > 0, F.struct("occurred_at", "_src.partition", "_src.offset", "id"))
        aggs += [F.min_by(F.get(seen, F.lit(0)), order).alias(f"t{i}"),
                 F.max(F.exists(seen, lambda t: t.rlike("^(DECIMAL|DOUBLE|FLOAT)"))).alias(f"f{i}")]
    row = named.agg(*aggs).collect()[0]
    out = {}
    for i, key in enumerate(mixed):
        t = logged_type(row[f"t{i}"]) if row[f"t{i}"] else "string"
        out[key] = "double" if t == "bigint" and row[f"f{i}"] else t
    return out


def _side(side: str, first: list[str] | None, types: dict[str, str], firsts: dict[tuple[str, str], str]) -> list[tuple[str, str]]:
    order = list(first or [])
    order += sorted(n for n in types if n not in set(order))
    return [(n, firsts.get((side, n)) or types.get(n, "string")) for n in order]


# --- C2 / C3: catalog --------------------------------------------------------

CATALOG_SCHEMA = "subject string, version int, schema string, registered_at string"


def _subject_folder(catalog: str, subject: str) -> str:
    return f"{catalog}/{quote(subject, safe='')}"


def lookup(spark: SparkSession, catalog: str, subject: str, version: int | None = None) -> PinnedSchema | None:
    """The latest registered schema of ``subject``, or the one of ``version``; None where nothing is registered.

    Read errors other than a missing folder are raised.
    """
    try:
        rows = spark.read.schema(CATALOG_SCHEMA).json(_subject_folder(catalog, subject))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if version is not None:
        rows = rows.where(F.col("version") == version)
    row = rows.orderBy(F.col("version").desc()).select("schema", "version").limit(1).collect()
    return PinnedSchema.from_json(row[0].schema, row[0].version) if row else None


def create_version(spark: SparkSession, catalog: str, subject: str, version: int, schema: PinnedSchema) -> bool:
    """Create a version unless it exists: False where another writer has it. A reader never sees half a file."""
    row = json.dumps({"subject": subject, "version": version, "schema": schema.to_json(), "registered_at": datetime.now(timezone.utc).isoformat()})
    return create_once(spark, _subject_folder(catalog, subject), f"{version:06d}.json", row + "\n")


def register(spark: SparkSession, catalog: str, subject: str, schema: PinnedSchema) -> int:
    """Append a new version, or reuse the latest one when identical."""
    while True:
        latest = lookup(spark, catalog, subject)
        if latest is not None and latest == schema:
            return latest.version
        version = (latest.version if latest else 0) + 1
        if create_version(spark, catalog, subject, version, schema):
            return version


def pin_first(spark: SparkSession, catalog: str, subject: str, schema: PinnedSchema) -> PinnedSchema:
    """Register ``schema`` as the first version; where another starter was first, its schema holds."""
    if create_version(spark, catalog, subject, 1, schema):
        return replace(schema, version=1)
    return lookup(spark, catalog, subject)


def resolve(named: DataFrame, catalog: str | None = None, subject: str | None = None) -> PinnedSchema:
    """C3 then C1 + C2: reuse the registered schema or infer and register it."""
    spark = named.sparkSession
    if not (catalog and subject):
        return infer_schema(named)
    return lookup(spark, catalog, subject) or pin_first(spark, catalog, subject, infer_schema(named))


# --- versions: a lattice of types ----------------------------------------------

def join_types(a: str, b: str) -> str | None:
    """The least type that holds both, None where there is none."""
    joined = _join(T.DataType.fromDDL(a), T.DataType.fromDDL(b))
    return None if joined is None else _ddl(joined)


def _join(a: T.DataType, b: T.DataType) -> T.DataType | None:
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if {type(a), type(b)} == {T.LongType, T.DoubleType}:
        return T.DoubleType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = _join(a.elementType, b.elementType)
        return None if inner is None else T.ArrayType(inner)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {f.name: f.dataType for f in a}
        for f in b:
            fields[f.name] = _join(fields[f.name], f.dataType) if f.name in fields else f.dataType
        return None if None in fields.values() else T.StructType([T.StructField(n, t) for n, t in fields.items()])
    return None


def _ddl(t: T.DataType) -> str:
    """Like ``simpleString``, with every field name quoted."""
    if isinstance(t, T.ArrayType):
        return f"array<{_ddl(t.elementType)}>"
    if isinstance(t, T.StructType):
        return f"struct<{', '.join(f'{_quoted(f.name)}: {_ddl(f.dataType)}' for f in t)}>"
    return t.simpleString()


def join_schemas(old: PinnedSchema, new: PinnedSchema) -> tuple[PinnedSchema, list[str]]:
    """The schema that holds both, in the old order with new columns after it, and the names of columns
    without a common type: these keep the old one."""
    refused: list[str] = []

    def side(before: list[tuple[str, str]], after: list[tuple[str, str]]) -> list[tuple[str, str]]:
        types = dict(before)
        for n, t in after:
            joined = join_types(types[n], t) if n in types else t
            if joined is None:
                refused.append(n)
            else:
                types[n] = joined
        return list(types.items())
    return PinnedSchema(side(old.inputs, new.inputs), side(old.outputs, new.outputs)), refused


def evolve(named: DataFrame, catalog: str, subject: str) -> PinnedSchema:
    """C1-C3 for a batch of a feed whose schema may grow: the version that holds the batch, registered where it is new.

    A writer that finds the version taken joins with the winner's and tries again, so no version loses a column.
    """
    spark = named.sparkSession
    seen = infer_schema(named, EVOLVING)
    while True:
        latest = lookup(spark, catalog, subject)
        wanted = seen if latest is None else join_schemas(latest, seen)[0]
        if latest is not None and wanted == latest:
            return latest
        version = (latest.version if latest else 0) + 1
        if create_version(spark, catalog, subject, version, wanted):
            return replace(wanted, version=version)


# --- C4: enforcement ---------------------------------------------------------

def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def align(named: DataFrame, schema: PinnedSchema) -> DataFrame:
    """Reorder every frame's cells to the pinned column order (by name, B7).

    Done once per inference, before the explode, so each datapoint then reads
    its cells by a constant index.
    """
    def side(frame: str, names: list[str]) -> str:
        arr = "array(" + ", ".join(_sql_str(n) for n in names) + ")" if names else "cast(array() as array<string>)"
        # Usually the frame already has the pinned order: keep its rows as they are.
        # Otherwise look the positions up once per inference, not once per row.
        moved = (f"element_at(transform(array(transform({arr}, n -> array_position({frame}.cols, n))), "
                 f"idx -> transform({frame}.rows, r -> transform(idx, k -> get(r, cast(k as int) - 1)))), 1)")
        return f"IF({frame}.cols = {arr}, {frame}.rows, {moved})"
    in_names = [n for n, _ in schema.inputs]
    out_names = [n for n, _ in schema.outputs]
    unknown = (f"size(array_except(inputs.cols, array({', '.join(_sql_str(n) for n in in_names) or 'NULL'}))) > 0 OR "
               f"size(array_except(outputs.cols, array({', '.join(_sql_str(n) for n in out_names) or 'NULL'}))) > 0")
    df = named.withColumn("_reason", F.coalesce(F.col("_reason"), F.when(F.expr(unknown), F.lit("unknown_column"))))
    return (df
            .withColumn("inputs", F.expr(f"named_struct('cols', inputs.cols, 'rows', "
                                         f"IF(_reason IS NULL, {side('inputs', in_names)}, inputs.rows), 'err', inputs.err)"))
            .withColumn("outputs", F.expr(f"named_struct('cols', outputs.cols, 'rows', "
                                          f"IF(_reason IS NULL, {side('outputs', out_names)}, outputs.rows), 'err', outputs.err)")))


def enforce(rows: DataFrame, schema: PinnedSchema) -> DataFrame:
    """C4 + P12 on zipped rows (``in_row`` / ``out_row`` aligned by :func:`align`).

    Returns ``id, occurred_at, <columns...>, _reason, _src`` where ``_reason`` flags
    datapoints with a cell that does not cast to the pinned type.
    """
    typed, bad = [], []
    for name, side, idx, typ in schema.layout():
        cell = F.expr(f"get({'in_row' if side == 'in' else 'out_row'}, {idx})")
        val = F.expr(f"try_variant_get(get({'in_row' if side == 'in' else 'out_row'}, {idx}), '$', {_sql_str(typ)})")
        typed.append(val.alias(name))
        bad.append(cell.isNotNull() & ~F.expr(f"is_variant_null(get({'in_row' if side == 'in' else 'out_row'}, {idx}))")
                   & val.isNull())
    mismatch = F.lit(False)
    for b in bad:
        mismatch = mismatch | b
    reason = F.coalesce(F.col("_reason"), F.when(mismatch, F.lit("type_mismatch")))
    return barrier(rows.select(
        F.concat(F.col("id"), F.lit("_"), F.col("pos").cast("string")).alias("id"),
        format_iso("occurred_at").alias("occurred_at"),
        *typed,
        reason.alias("_reason"),
        F.col("_src"),
    ))
