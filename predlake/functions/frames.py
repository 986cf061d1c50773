"""Payload -> frame: P2-P7 as Catalyst expressions over VARIANT.

A *frame* is the parsed table of one request or response::

    struct<cols: array<string>, rows: array<array<variant>>, err: string>

``cols`` keeps the first-seen column order (VARIANT itself sorts object keys,
so dict rows are re-read from the text with ``from_json(..., map<string,variant>)``
which keeps key order). ``rows`` are row-major VARIANT cells, NULL where a
value is missing. ``err`` is NULL when the payload parsed, else the
quarantine reason.

All builders return SQL text (wrap with ``F.expr``). Every
branch sits inside ``CASE`` so only the branch a payload needs is evaluated.
A body is parsed once (:func:`parse_body`); only dict rows and dicts of columns
are read a second time, for their key order.
"""

from __future__ import annotations

import itertools

from predlake.model import (
    V1_REQUEST_KEY, V1_RESPONSE_KEY, V2_REQUEST_KEY, V2_RESPONSE_KEY,
)

_ids = itertools.count()

_NULL_COLS = "cast(null as array<string>)"
_NULL_ROWS = "cast(null as array<array<variant>>)"
_EMPTY_COLS = "cast(array() as array<string>)"
_EMPTY_ROWS = "cast(array() as array<array<variant>>)"
TENSOR_DDL = "array<struct<name: string, shape: array<variant>, data: array<variant>>>"


def _v() -> str:
    """A fresh lambda variable name (lambdas may nest)."""
    return f"_l{next(_ids)}"


def let(value: str, body) -> str:
    """Bind ``value`` once and use it in ``body(name)`` without recomputing it."""
    n = _v()
    return f"element_at(transform(array({value}), {n} -> {body(n)}), 1)"


def frame(cols: str, rows: str, err: str = "cast(null as string)") -> str:
    return f"named_struct('cols', {cols}, 'rows', {rows}, 'err', {err})"


def error(reason: str) -> str:
    return frame(_NULL_COLS, _NULL_ROWS, f"'{reason}'")


EMPTY = frame(_EMPTY_COLS, _EMPTY_ROWS)


def positions(n: str) -> str:
    """``sequence(0, n-1)``, empty for n <= 0 (``sequence(0,-1)`` counts down)."""
    return f"IF({n} > 0, sequence(0, {n} - 1), cast(array() as array<int>))"


def positional_names(n: str) -> str:
    i = _v()
    return f"transform({positions(n)}, {i} -> cast({i} as string))"


def list_rows(lists: str) -> str:
    """P6, list of lists: positional columns, ragged rows padded with NULL."""
    def body(la):
        r, s, i = _v(), _v(), _v()
        n = f"coalesce(array_max(transform({la}, {r} -> size({r}))), 0)"

        def with_n(nv):
            rows = (f"IF(forall({la}, {s} -> size({s}) = {nv}), {la}, "
                    f"transform({la}, {s} -> transform({positions(nv)}, {i} -> get({s}, {i}))))")
            return frame(positional_names(nv), rows)
        return let(n, with_n)
    return let(lists, body)


def object_rows(maps: str) -> str:
    """P6, list of dicts: union of keys in first-seen order, missing -> NULL."""
    def body(om):
        m = _v()
        cols = f"array_distinct(flatten(transform({om}, {m} -> map_keys({m}))))"

        def with_cols(cs):
            mm, c = _v(), _v()
            return frame(cs, f"transform({om}, {mm} -> transform({cs}, {c} -> element_at({mm}, {c})))")
        return let(cols, with_cols)
    k, u = _v(), _v()

    def last_wins(om):
        return (f"IF(exists({om}, {k} -> size({k}) <> size(array_distinct(map_keys({k})))), "
                f"transform({om}, {u} -> map_from_entries(map_entries({u}))), {om})")
    return let(let(maps, last_wins), body)


def rows_frame(arr: str, objects: str, allow_scalars: bool = True,
               not_list: str = "rows_not_a_list") -> str:
    """Normalize a list of rows (lists, dicts or scalars) into a frame.

    ``arr`` is the rows as ``array<variant>``; ``objects`` re-reads the same rows
    as ``array<map<string,variant>>`` from the text (only evaluated for dict rows).
    Mixed kinds are refused, scalars only where ``allow_scalars``.
    """
    def body(a):
        r, x = _v(), _v()
        as_lists = f"transform({a}, {r} -> try_variant_get({r}, '$', 'array<variant>'))"

        def with_lists(la):
            n_lists = f"size(filter({la}, {x} -> {x} IS NOT NULL))"
            y = _v()
            is_obj = f"exists({a}, {y} -> try_variant_get({y}, '$', 'map<string,variant>') IS NOT NULL)"
            z = _v()
            scalars = (frame("array('0')", f"transform({a}, {z} -> array({z}))")
                       if allow_scalars else error("scalar_rows"))
            return (f"CASE WHEN size({a}) = 0 THEN {EMPTY} "
                    f"WHEN {n_lists} = size({a}) THEN {list_rows(la)} "
                    f"WHEN {n_lists} > 0 THEN {error('mixed_row_kinds')} "
                    f"WHEN {is_obj} THEN coalesce({object_rows(objects)}, {error('mixed_row_kinds')}) "
                    f"ELSE {scalars} END")
        return let(as_lists, with_lists)
    inner = let(arr, body)
    return f"CASE WHEN {arr} IS NULL THEN {error(not_list)} ELSE {inner} END"


def tensors_frame(tensors: str, matrix_objects: str) -> str:
    """V2 named tensors -> frame.

    One tensor with a 2-D shape is a matrix: its ``data`` are the rows and the
    tensor name is dropped (P5). Otherwise every tensor is one column named
    after it (P4); a repeated name keeps its first position and its last data,
    like a Python dict; unequal lengths are refused.
    """
    def body(t):
        x, y, nm, u0 = _v(), _v(), _v(), _v()
        first = f"element_at({t}, 1)"
        is_matrix = f"(size({t}) = 1 AND coalesce(size({first}.shape), 0) = 2)"
        names = f"transform({t}, {x} -> {x}.name)"
        dedup = (f"IF(size(array_distinct({names})) = size({t}), {t}, "
                 f"transform(array_distinct({names}), {nm} -> "
                 f"element_at(filter({t}, {y} -> {y}.name <=> {nm}), -1)))")

        def named(u):
            a, b, i, c = _v(), _v(), _v(), _v()
            n = f"size(element_at({u}, 1).data)"
            rows = f"transform({positions(n)}, {i} -> transform({u}, {c} -> get({c}.data, {i})))"
            return (f"CASE WHEN exists({u}, {a} -> {a}.name IS NULL) THEN {error('bad_tensors')} "
                    f"WHEN exists({u}, {a} -> {a}.data IS NULL) THEN {error('bad_tensor_data')} "
                    f"WHEN NOT forall({u}, {b} -> size({b}.data) = {n}) "
                    f"THEN {error('unequal_tensor_lengths')} "
                    f"ELSE {frame(f'transform({u}, {u0} -> {u0}.name)', rows)} END")
        matrix = rows_frame(f"{first}.data", matrix_objects, allow_scalars=True,
                            not_list="bad_tensor_data")
        return (f"CASE WHEN size({t}) = 0 THEN {EMPTY} "
                f"WHEN {is_matrix} THEN {matrix} "
                f"ELSE {let(dedup, named)} END")
    inner = let(tensors, body)
    return f"CASE WHEN {tensors} IS NULL THEN {error('bad_tensors')} ELSE {inner} END"


# --- one strict parse per body ----------------------------------------------------
#
# The text is read as the first field of an object whose last field is a mark: a
# truncated text, a list or NaN never lets the parser reach the mark. What follows a
# first object and a comma could still pass as further fields, or end the object
# early. So the text must also be the first of exactly two values of a list: there
# only another value may follow a comma, here only a name and a colon.

PAYLOAD_KEYS = (V1_REQUEST_KEY, V2_REQUEST_KEY, V1_RESPONSE_KEY, V2_RESPONSE_KEY)
_MARK = "end of body"
_STRICT = "map('allowNonNumericNumbers', 'false', 'allowSingleQuotes', 'false')"


def parse_body(text: str, payload: str = "") -> str:
    """The fields of one JSON object as a struct, NULL unless ``text`` is exactly that.

    A payload key is NULL where absent and a VARIANT null where null.
    """
    return let(whole_body(text, payload), lambda w: body_of(w, text))


def whole_body(text: str, payload: str = "") -> str:
    """The text read as the first field of an object; :func:`body_of` is the strict body of it, from a column that holds it."""
    payload = payload or ", ".join(f"{k}: variant" for k in PAYLOAD_KEYS)
    fields = f"id: variant, model_name: string, model_version: string, occurred_at: string, {payload}"
    return f"from_json(concat('{{\"body\":', {text}, ',\"{_MARK}\":1}}'), 'struct<body: struct<{fields}>, `{_MARK}`: int>', {_STRICT})"


def body_of(whole: str, text: str) -> str:
    return f"IF({whole}.`{_MARK}` = 1 AND {one_value(text)}, {whole}.body, NULL)"


def one_value(text: str) -> str:
    """Whether nothing but white space stands beside one JSON value (tokens are counted, nothing is built)."""
    return f"coalesce(json_array_length(concat('[', {text}, ',1]')) = 2, FALSE)"


def unread(text: str, key: str, missing: str) -> str:
    """Why a payload is NULL: its key is absent, or present with a value that is no strict JSON."""
    return f"IF(coalesce(array_contains(json_object_keys({text}), '{key}'), TRUE), 'malformed_body', '{missing}')"


def columns_frame(columns: str) -> str:
    """P6, a dict of columns (``map<string, array<variant>>``): one row per position, unequal lengths refused."""
    def body(m):
        a, b, c, i = _v(), _v(), _v(), _v()
        vals = f"map_values({m})"
        n = f"coalesce(size(element_at({vals}, 1)), 0)"
        rows = f"transform({positions(n)}, {i} -> transform({vals}, {c} -> get({c}, {i})))"
        return (f"CASE WHEN {m} IS NULL OR exists({vals}, {a} -> {a} IS NULL) THEN {error('rows_not_a_list')} "
                f"WHEN size({m}) = 0 THEN {EMPTY} "
                f"WHEN NOT forall({vals}, {b} -> size({b}) = {n}) THEN {error('unequal_column_lengths')} "
                f"ELSE {frame(f'map_keys({m})', rows)} END")
    return let(columns, body)


def _records(v: str, text: str, key: str, allow_scalars: bool) -> str:
    """P6 on a payload: a list of rows, or a dict of columns. Dict keys are re-read from the text, which keeps their order."""
    columns = columns_frame(f"from_json({text}, 'struct<{key}: map<string,array<variant>>>').{key}")

    def body(arr):
        rows = rows_frame(arr, f"from_json({text}, 'struct<{key}: array<map<string,variant>>>').{key}", allow_scalars=allow_scalars)
        return f"IF({arr} IS NULL AND try_variant_get({v}, '$', 'map<string,variant>') IS NOT NULL, {columns}, {rows})"
    return let(f"try_variant_get({v}, '$', 'array<variant>')", body)


def _tensors(v: str, text: str, key: str) -> str:
    objects = f"element_at(from_json({text}, 'struct<{key}: array<struct<data: array<map<string,variant>>>>>').{key}, 1).data"
    return tensors_frame(f"try_variant_get({v}, '$', '{TENSOR_DDL}')", objects)


def _kserve_frame(body: str, text: str, v1_key: str, v2_key: str, missing: str) -> str:
    v1, v2 = f"{body}.{v1_key}", f"{body}.{v2_key}"
    return (f"CASE WHEN {body} IS NULL THEN {error('malformed_body')} "
            f"WHEN {v1} IS NOT NULL THEN IF(is_variant_null({v1}), {EMPTY}, {_records(v1, text, v1_key, True)}) "
            f"WHEN {v2} IS NOT NULL THEN {_tensors(v2, text, v2_key)} "
            f"ELSE {frame(_NULL_COLS, _NULL_ROWS, f'IF(coalesce(array_contains(json_object_keys({text}), {_q(v1_key)}), TRUE), {_q(_BAD)}, {unread(text, v2_key, missing)})')} END")


_BAD = "malformed_body"


def _q(s: str) -> str:
    return f"'{s}'"


def request_frame_sql(body: str, text: str) -> str:
    """P2 / P4 / P5 / P7 on a parsed body: ``instances`` beats ``inputs``; neither -> error."""
    return _kserve_frame(body, text, V1_REQUEST_KEY, V2_REQUEST_KEY, "no_instances_or_inputs")


def response_frame_sql(body: str, text: str) -> str:
    """P3 / P4 / P5 / P7 on a parsed body: ``predictions`` beats ``outputs``; neither -> error."""
    return _kserve_frame(body, text, V1_RESPONSE_KEY, V2_RESPONSE_KEY, "no_predictions_or_outputs")


RECORDS_DDL = "array<map<string,variant>>"


def records_frame_sql(records: str, text: str, key: str) -> str:
    """P1 / P6 for JSON events. ``records`` holds the payload where it is a list of dicts, the usual event, in key
    order; all else (lists, a dict of columns, null, absent) is read from the text."""
    x = _v()
    other = let(parse_body(text, f"{key}: variant"), lambda b: (
        f"CASE WHEN {b}.{key} IS NULL THEN {frame(_NULL_COLS, _NULL_ROWS, unread(text, key, 'missing_' + key))} "
        f"WHEN is_variant_null({b}.{key}) THEN {error('missing_' + key)} "
        f"ELSE {_records(b + '.' + key, text, key, False)} END"))
    return (f"CASE WHEN {records} IS NOT NULL AND forall({records}, {x} -> {x} IS NOT NULL) THEN {object_rows(records)} "
            f"ELSE {other} END")
