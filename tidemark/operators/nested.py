"""Nested-document operators: connection unwrap, path rewrites, struct flatten, child-table explode.

Everything here is schema-driven: the DataFrame schema is walked once on the driver and turned into a
single projection of native JVM expressions (``withField``, field extraction over arrays, ``posexplode``,
``transform``); no Python runs per row. Struct rewrites and array field extraction run in generated code;
``transform`` lambdas are evaluated by the JVM interpreter, which is why the table builders explode lists
first and rewrite flat rows where they can.

Path syntax (shared by unwrap / hashing / rewrites): ``a.b`` walks into struct fields, ``a[*].b``
walks into every element of the array ``a``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from ..functions.ids import gid_to_long
from ..naming import nested_name

Rewrite = Callable[[Column, DataType], Column]


# ---------------------------------------------------------------------------------------------
# path helpers
# ---------------------------------------------------------------------------------------------

def parse_path(path: str) -> list[str]:
    """``refunds[*].note`` -> ``['refunds', '*', 'note']``."""
    parts: list[str] = []
    for token in path.split("."):
        if token.endswith("[*]"):
            parts.extend([token[:-3], "*"])
        else:
            parts.append(token)
    return parts


def _field(dtype: StructType, name: str):
    for f in dtype.fields:
        if f.name == name:
            return f
    return None


def path_exists(schema: StructType, path: str) -> bool:
    dtype: DataType = schema
    for part in parse_path(path):
        if part == "*":
            if not isinstance(dtype, ArrayType):
                return False
            dtype = dtype.elementType
        else:
            if not isinstance(dtype, StructType):
                return False
            f = _field(dtype, part)
            if f is None:
                return False
            dtype = f.dataType
    return True


def _apply(c: Column, dtype: DataType, parts: list[str], fn: Rewrite) -> Column:
    if not parts:
        return fn(c, dtype)
    head, rest = parts[0], parts[1:]
    if head == "*":
        if not isinstance(dtype, ArrayType):
            return c
        return F.transform(c, lambda x: _apply(x, dtype.elementType, rest, fn))
    if not isinstance(dtype, StructType):
        return c
    f = _field(dtype, head)
    if f is None:  # absent path: no-op
        return c
    return c.withField(head, _apply(c.getField(head), f.dataType, rest, fn))


def rewrite_path(df: DataFrame, path: str, fn: Rewrite) -> DataFrame:
    """Replace the value at ``path`` (any depth, through arrays) by ``fn(value, type)``.

    Missing paths are a no-op. NULL parents stay NULL (``withField`` / ``transform`` propagate NULL).
    """
    parts = parse_path(path)
    top = _field(df.schema, parts[0])
    if top is None:
        return df
    new = _apply(F.col(f"`{parts[0]}`"), top.dataType, parts[1:], fn)
    return df.withColumn(parts[0], new)


def rewrite_paths(df: DataFrame, paths: Iterable[str], fn: Rewrite) -> DataFrame:
    for p in paths:
        df = rewrite_path(df, p, fn)
    return df


# ---------------------------------------------------------------------------------------------
# B1 connection unwrap, B17 truncation report
# ---------------------------------------------------------------------------------------------

def unwrap_connection_expr(c: Column, dtype: DataType) -> Column:
    """``{nodes:[..]}`` -> nodes; else ``{edges:[{node:..}]}`` -> [node]; anything else unchanged.

    ``nodes`` wins when both are present. Lists are returned as-is.
    """
    if not isinstance(dtype, StructType):
        return c
    names = {f.name for f in dtype.fields}
    from_edges = None
    if "edges" in names:
        # Field extraction over an array of structs (no lambda): stays in generated code.
        from_edges = c.getField("edges").getField("node")
    if "nodes" in names:
        nodes = c.getField("nodes")
        return nodes if from_edges is None else F.coalesce(nodes, from_edges)
    if from_edges is not None:
        return from_edges
    return c


def unwrap_connections(df: DataFrame, paths: Iterable[str]) -> DataFrame:
    return rewrite_paths(df, paths, unwrap_connection_expr)


def truncation_report(df: DataFrame, parent_key: str, fields: Iterable[str]) -> DataFrame:
    """Rows ``(parent_id, field, n_nodes)`` for every connection whose ``pageInfo.hasNextPage`` is true.

    Must run on the raw (still wrapped) connections; one narrow projection per field, unioned.
    """
    parts = []
    for field in fields:
        f = _field(df.schema, field)
        if f is None or not isinstance(f.dataType, StructType) or _field(f.dataType, "pageInfo") is None:
            continue
        c = F.col(f"`{field}`")
        nodes = unwrap_connection_expr(c, f.dataType)
        parts.append(
            df.where(c.getField("pageInfo").getField("hasNextPage"))
            .select(
                F.col(parent_key).alias("parent_id"),
                F.lit(field).alias("field"),
                F.size(nodes).cast("bigint").alias("n_nodes"),
            )
        )
    if not parts:
        raise ValueError("no connection with pageInfo among the given fields")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _cut_connections(c: Column | None, struct: StructType, path: str, parent: Column) -> list[Column]:
    """For each connection below a struct that has a page, an array of (field, parent_id, n_nodes): empty if all is there."""
    out = []
    for f in struct.fields:
        value = F.col(f"`{f.name}`") if c is None else c.getField(f.name)
        here, kind = f"{path}.{f.name}" if path else f.name, f.dataType
        if isinstance(kind, StructType) and {"edges", "nodes"} & set(kind.names):
            nodes = unwrap_connection_expr(value, kind)
            if "pageInfo" in kind.names and "hasNextPage" in kind["pageInfo"].dataType.names:
                row = F.struct(F.lit(here).alias("field"), parent.cast("string").alias("parent_id"), F.size(nodes).cast("bigint").alias("n_nodes"))
                out.append(F.when(value.getField("pageInfo").getField("hasNextPage"), F.array(row)))
            if "nodes" in kind.names:
                inner = kind["nodes"].dataType.elementType
            else:
                inner = kind["edges"].dataType.elementType["node"].dataType
            out += _in_list(nodes, inner, here, parent)
        elif isinstance(kind, ArrayType):
            out += _in_list(value, kind.elementType, here, parent)
        elif isinstance(kind, StructType):
            own = value.getField("id") if "id" in kind.names else parent
            out += _cut_connections(value, kind, here, own)
    return out


def _in_list(items: Column, kind: DataType, path: str, parent: Column) -> list[Column]:
    if not isinstance(kind, StructType) or not _pages_below(kind):
        return []

    def of(x: Column) -> Column:
        parts = _cut_connections(x, kind, path, x.getField("id") if "id" in kind.names else parent)
        return F.concat(*[F.coalesce(p, F.array().cast(_CUT)) for p in parts])

    return [F.flatten(F.transform(items, of))]


_CUT = "array<struct<field:string,parent_id:string,n_nodes:bigint>>"


def _pages_below(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _pages_below(kind.elementType)
    if isinstance(kind, StructType):
        return any((f.name == "pageInfo") or _pages_below(f.dataType) for f in kind.fields)
    return False


def truncations(df: DataFrame) -> DataFrame | None:
    """B17 at any depth: (field, parent_id, n_nodes) of every connection whose page says that there is more.

    ``field`` is the path of the connection, ``parent_id`` the id of the node that it belongs to as it was landed. One
    pass over the rows, however many connections the schema has; None if it has none.
    """
    parts = _cut_connections(None, df.schema, "", F.col("id") if "id" in df.columns else F.lit(None))
    if not parts:
        return None
    found = F.concat(*[F.coalesce(p, F.array().cast(_CUT)) for p in parts])
    return df.select(F.explode(found).alias("__x")).select("__x.*")


# ---------------------------------------------------------------------------------------------
# B11 schema-wide id normalisation
# ---------------------------------------------------------------------------------------------

def _has_leaf(dtype: DataType, leaf: str) -> bool:
    if isinstance(dtype, StructType):
        return any((f.name == leaf and isinstance(f.dataType, StringType)) or _has_leaf(f.dataType, leaf)
                   for f in dtype.fields)
    if isinstance(dtype, ArrayType):
        return _has_leaf(dtype.elementType, leaf)
    return False


def _rewrite_leaves(c: Column, dtype: DataType, leaf: str, fn: Callable[[Column], Column]) -> Column:
    if isinstance(dtype, StructType):
        if not _has_leaf(dtype, leaf):
            return c
        out = c
        for f in dtype.fields:
            if f.name == leaf and isinstance(f.dataType, StringType):
                out = out.withField(f.name, fn(c.getField(f.name)))
            elif _has_leaf(f.dataType, leaf):
                out = out.withField(f.name, _rewrite_leaves(c.getField(f.name), f.dataType, leaf, fn))
        return out
    if isinstance(dtype, ArrayType):
        if not _has_leaf(dtype.elementType, leaf):
            return c
        return F.transform(c, lambda x: _rewrite_leaves(x, dtype.elementType, leaf, fn))
    return c


def normalize_ids(df: DataFrame, leaf: str = "id", fn: Callable[[Column], Column] = gid_to_long) -> DataFrame:
    """Every string field named ``leaf`` at any depth (incl. inside arrays) -> ``fn(value)`` (bigint)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name == leaf and isinstance(f.dataType, StringType):
            cols.append(fn(c).alias(f.name))
        elif _has_leaf(f.dataType, leaf):
            cols.append(_rewrite_leaves(c, f.dataType, leaf, fn).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


# ---------------------------------------------------------------------------------------------
# B2 / B18 struct flatten
# ---------------------------------------------------------------------------------------------

def flatten_columns(schema: StructType, snake: bool = True, keep_arrays: bool = True,
                    prefix: list[str] | None = None) -> list[Column]:
    prefix = prefix or []
    out: list[Column] = []
    for f in schema.fields:
        path = [*prefix, f.name]
        ref = F.col(".".join(f"`{p}`" for p in path))
        if isinstance(f.dataType, StructType):
            out.extend(flatten_columns(f.dataType, snake, keep_arrays, path))
        elif isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StructType):
            if keep_arrays:
                out.append(ref.alias(nested_name(path, snake)))
        else:
            out.append(ref.alias(nested_name(path, snake)))
    return out


def flatten(df: DataFrame, snake: bool = True, keep_arrays: bool = False) -> DataFrame:
    """Nested structs -> ``parent__child`` columns at any depth, snake_case names.

    Arrays of structs become child tables (``explode_child``) and are dropped unless ``keep_arrays``;
    arrays of scalars stay as array columns.
    """
    return df.select(*flatten_columns(df.schema, snake=snake, keep_arrays=keep_arrays))


# ---------------------------------------------------------------------------------------------
# C0 child tables
# ---------------------------------------------------------------------------------------------

def explode_list(df: DataFrame, array: Column | str, *carried: Column | str, pos: str = "__pos", elem: str = "__elem") -> DataFrame:
    """``carried`` with the position and element of each of the array's elements; NULL and empty arrays yield no rows.

    The outer form with a filter behind it: for the inner one Spark filters by the array's size first, which computes a
    derived array twice.
    """
    out = df.select(*carried, F.posexplode_outer(array).alias(pos, elem))
    return out.where(F.col(f"`{pos}`").isNotNull())


def explode_child(df: DataFrame, array_col: str, keys: dict[str, str], index: str | None = None,
                  scalar_name: str = "value") -> DataFrame:
    """One row per element of ``array_col``; parent columns in ``keys`` (old -> new name) carried along.

    ``index`` adds the 0-based position (BIGINT). Elements that are structs are expanded to columns;
    scalars land in ``scalar_name``. NULL and empty arrays yield no rows. Parent keys are renamed
    *before* the explode so a child ``id`` never collides with the parent ``id``.
    """
    f = _field(df.schema, array_col)
    if f is None or not isinstance(f.dataType, ArrayType):
        raise ValueError(f"{array_col} is not an array column")
    carried = [F.col(f"`{k}`").alias(v) for k, v in keys.items()]
    exploded = explode_list(df, F.col(f"`{array_col}`"), *carried)
    elem_t = f.dataType.elementType
    if isinstance(elem_t, StructType):
        body = [F.col(f"__elem.`{e.name}`").alias(e.name) for e in elem_t.fields if e.name not in keys.values()]
    else:
        body = [F.col("__elem").alias(scalar_name)]
    pos = [F.col("__pos").cast("bigint").alias(index)] if index else []
    return exploded.select(*[F.col(f"`{v}`") for v in keys.values()], *pos, *body)
