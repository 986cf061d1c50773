"""ST1: the entries of a group's ``MapState``, read and written many at a time.

Each call of a Python ``MapState`` is a request to the task's state server in the JVM and a wait for its answer. The server
answers requests in the order in which they come, so :class:`Entries` sends many of one kind before it reads
their answers. Rows are made as the client of Spark makes them. A state without that client (a test's) is called entry by entry.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

from pyspark import cloudpickle

MOST_CALLS, MOST_BYTES = 128, 32_768   # sent before answers are read: all of it fits the buffers of the socket, so neither side waits for the other

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Entries:
    """Entries are key -> value, both tuples of what the state's columns hold."""

    def __init__(self, state) -> None:
        self.state = state
        self.client = getattr(state, "_mapStateClient", None)

    def get(self, entries: Iterable[tuple]) -> dict[tuple, tuple]:
        """Those of the entries that are there."""
        entries = list(entries)
        if self.client is None:
            found = [self.state.getValue(x) for x in entries]
        else:
            found = self._call("getValue", "GetValue", ({"userKey": self._dump(x)} for x in entries))
            found = [self._row(x) if x else None for x in found]
        return {x: tuple(v) for x, v in zip(entries, found) if v is not None}

    def put(self, items: list[tuple]) -> None:
        if self.client is None:
            for x, value in items:
                self.state.updateValue(x, value)
        else:
            self._call("updateValue", "UpdateValue", ({"userKey": self._dump(x), "value": self._dump(value)} for x, value in items))

    def remove(self, entries: list[tuple], all_of_them: bool = False) -> None:
        if self.client is None:
            for x in entries:
                self.state.removeKey(x)
        elif all_of_them:
            self.state.clear()
        else:
            self._call("removeKey", "RemoveKey", ({"userKey": self._dump(x)} for x in entries))

    def all(self) -> Iterator[tuple]:
        yield from list(self.state.iterator())

    # --- the state server's protocol ---------------------------------------------

    def _dump(self, row: tuple) -> bytes:
        return self.client._stateful_processor_api_client.pickleSer.dumps(row)

    def _row(self, data: bytes):
        return self.client._stateful_processor_api_client._deserialize_from_bytes(data)

    def _call(self, field: str, kind: str, calls: Iterable[dict]) -> list[bytes]:
        import pyspark.sql.streaming.proto.StateMessage_pb2 as proto
        from pyspark.serializers import write_int
        api, make = self.client._stateful_processor_api_client, getattr(proto, kind)
        answers, waiting, size = [], 0, 0

        def read():
            api.sockfile.flush()
            for _ in range(waiting):
                status, error, value = api._receive_proto_message()
                if status != 0:
                    raise RuntimeError(f"{field} of the state failed: {error}")
                answers.append(value)
        for call in calls:
            request = proto.StateRequest(stateVariableRequest=proto.StateVariableRequest(
                mapStateCall=proto.MapStateCall(stateName=self.state._stateName, **{field: make(**call)}))).SerializeToString()
            if waiting and (waiting == MOST_CALLS or size + len(request) > MOST_BYTES):
                read()
                waiting = size = 0
            write_int(0, api.sockfile)
            write_int(len(request), api.sockfile)
            api.sockfile.write(request)
            waiting, size = waiting + 1, size + len(request) + 8
        read()
        return answers
