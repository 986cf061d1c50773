"""Payload layouts by behaviour: tensors, matrices, row lists, dicts, dispatch."""

import pytest

from helpers import frame_of, pair
from predlake.operators.correlate import kserve_inferences
from predlake.plans.logger import datapoints


def tensor(name, shape, data, datatype="FP64"):
    return {"name": name, "shape": shape, "datatype": datatype, "data": data}


@pytest.mark.parametrize("n", [1, 2, 7])
def test_a_tensor_is_a_column(spark, n):
    data = [-1.5e9 * i for i in range(n)]
    assert frame_of(spark, {"inputs": [tensor("depth", [n], data)]}) == (["depth"], [[x] for x in data], None)


def test_tensors_are_columns_side_by_side(spark):
    names = ["größe", "b c", "z", "a", "_"]
    cols, rows, _ = frame_of(spark, {"outputs": [tensor(n, [2], [10 * i, -i]) for i, n in enumerate(names)]}, side="response")
    assert cols == names and rows == [[10 * i for i in range(5)], [-i for i in range(5)]]


@pytest.mark.parametrize("height,width", [(1, 5), (3, 2)])
def test_a_lone_matrix_gives_positional_columns(spark, height, width):
    grid = [[r * 100 + c - 0.25 for c in range(width)] for r in range(height)]
    assert frame_of(spark, {"inputs": [tensor("grid", [height, width], grid)]}) == ([str(c) for c in range(width)], grid, None)


def test_a_matrix_among_tensors_gives_list_cells(spark):
    cols, rows, _ = frame_of(spark, {"inputs": [tensor("xy", [3, 2], [[9, 8], [7, 6], [5, 4]]), tensor("tag", [3], ["é", "", "日本"], "BYTES")]})
    assert cols == ["xy", "tag"] and rows == [[[9, 8], "é"], [[7, 6], ""], [[5, 4], "日本"]]


def test_column_types_follow_the_cells(spark):
    req = {"inputs": [tensor("open", [2], [False, True], "BOOL"), tensor("temp", [2], [-273.15, 1e6]),
                      tensor("count", [2], [-(2 ** 40), 0], "INT64"), tensor("word", [2], ["ja", "nö"], "BYTES")]}
    logged = datapoints(kserve_inferences(pair(spark, req, {"outputs": [tensor("rank", [2], [4, 9], "INT32")]})))
    assert logged.schema.inputs == [("open", "boolean"), ("temp", "double"), ("count", "bigint"), ("word", "string")]
    assert logged.schema.outputs == [("rank", "bigint")]
    rows = [tuple(r)[2:] for r in logged.good.orderBy("id").collect()]
    assert rows == [(False, -273.15, -(2 ** 40), "ja", 4), (True, 1e6, 0, "nö", 9)]


def test_lists_of_rows_and_scalars(spark):
    assert frame_of(spark, {"instances": [["x", -1, None]]}) == (["0", "1", "2"], [["x", -1, None]], None)
    assert frame_of(spark, {"predictions": [0.125, "no", None]}, side="response") == (["0"], [[0.125], ["no"], [None]], None)


def test_dicts_of_columns(spark):
    assert frame_of(spark, {"instances": {"z": [1, 2], "a": ["p", "q"]}}) == (["z", "a"], [[1, "p"], [2, "q"]], None)
    assert frame_of(spark, {"predictions": {"y": [1], "x": [1, 2]}}, side="response")[2] == "unequal_column_lengths"
    assert frame_of(spark, {"instances": {"y": 1}})[2] == "rows_not_a_list"


def test_repeated_keys_keep_the_last(spark):
    assert frame_of(spark, '{"instances": [{"a": 1, "a": 2}]}') == (["a"], [[2]], None)


# --- more cases ---------------------------------------------------------------------

def test_instances_beat_inputs(spark):
    cols, rows, _ = frame_of(spark, {"instances": [[1]], "inputs": [tensor("a", [1], [9])]})
    assert cols == ["0"] and rows == [[1]]


def test_neither_payload_key(spark):
    assert frame_of(spark, {"foo": 1})[2] == "no_instances_or_inputs"
    assert frame_of(spark, {"foo": 1}, side="response")[2] == "no_predictions_or_outputs"


def test_unequal_tensor_lengths(spark):
    assert frame_of(spark, {"inputs": [tensor("a", [2], [1, 2]), tensor("b", [3], [1, 2, 3])]})[2] \
        == "unequal_tensor_lengths"


def test_ragged_rows_padded(spark):
    cols, rows, _ = frame_of(spark, {"instances": [[1, 2], [3]]})
    assert cols == ["0", "1"] and rows == [[1, 2], [3, None]]


def test_dict_rows_first_seen_order(spark):
    cols, rows, _ = frame_of(spark, {"instances": [{"b": 1, "a": 2}, {"c": 3, "b": 4}]})
    assert cols == ["b", "a", "c"] and rows == [[1, 2, None], [4, None, 3]]


def test_eleven_positional_columns(spark):
    cols, rows, _ = frame_of(spark, {"instances": [list(range(11))]})
    assert cols == [str(i) for i in range(11)] and rows == [list(range(11))]


def test_repeated_tensor_name_last_wins(spark):
    cols, rows, _ = frame_of(spark, {"inputs": [tensor("a", [2], [1, 2]), tensor("b", [2], [3, 4]),
                                                tensor("a", [2], [5, 6])]})
    assert cols == ["a", "b"] and rows == [[5, 3], [6, 4]]


def test_mixed_row_kinds_and_malformed(spark):
    assert frame_of(spark, {"instances": [[1], {"a": 1}]})[2] == "mixed_row_kinds"
    assert frame_of(spark, '{"instances": [[')[2] == "malformed_body"


def test_unnamed_tensor_is_refused(spark):
    assert frame_of(spark, {"inputs": [{"shape": [1], "data": [1]}]})[2] == "bad_tensors"


@pytest.mark.parametrize("payload", [{"instances": []}, {"instances": None}, {"inputs": []}])
def test_empty_payloads(spark, payload):
    cols, rows, err = frame_of(spark, payload)
    assert err is None and cols == [] and rows == []
