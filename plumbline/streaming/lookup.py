"""Lookups that depend on order, on a stream (D2-D4, E3): what the table operators give, row by row of event time.

Two inputs meet in one keyed state: both are brought to ``(key, ts, uid, data)`` and put together, and
the second part of the order says which comes first at one instant.  Each input needs a watermark;
the slower one decides.
"""

from __future__ import annotations

import json
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.dedup import WINDOW_MS, params_fingerprint
from plumbline.operators.lookup import FRESH_MS
from plumbline.streaming.stateful import _InOrder, _stateful

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: fixed value: how long a request for a specification may stay without an answer
ANSWER_MS = 2_000


def _fetch_order(fetch_id: str = "fetch_id") -> Column:
    """Fetches stand before events of the same instant, in order of their number."""
    return F.concat(F.lit("0"), F.lpad(F.col(fetch_id).cast("string"), 20, "0"))


def _event_order() -> Column:
    return F.concat(F.lit("1"), F.coalesce("uid", F.lit("")))


def _data(*values: Column | str) -> Column:
    """Values as JSON text; a missing one stays null."""
    return F.to_json(F.array(*[(F.col(v) if isinstance(v, str) else v).cast("string") for v in values]))


def _two(first: DataFrame, second: DataFrame, keys: list[str], processor: _InOrder, schema: str) -> DataFrame:
    return _stateful(first.unionByName(second), keys, F.col("data"), processor, schema)


def _rows(df: DataFrame, keys: list[Column], order: Column, data: Column) -> DataFrame:
    return df.select(*keys, "ts", order.alias("uid"), data.alias("data"))


# ---------------------------------------------------------------- E3


class _Seen(_InOrder):
    columns = ["uid", "seen_by_codegen", "payload"]

    def replay(self, key, rows, memory):
        out = []
        for ms, order, data in rows:
            if order[0] == "0":
                memory = ms
            else:
                uid, payload = json.loads(data)
                out.append((uid, memory is not None and ms - memory <= WINDOW_MS, payload))
        return out, memory

    def end_of(self, memory):
        return 0 if memory is None else memory + WINDOW_MS


def seen_by_codegen_stream(checks: DataFrame, events: DataFrame, payload: Column | None = None) -> DataFrame:
    """``uid`` of each check, ``seen_by_codegen`` and ``payload`` (text that goes along), as ``seen_by_codegen``."""
    key = [F.col("client_id"), params_fingerprint(F.col("props")).alias("params")]
    told = _rows(events.filter(F.col("source") == "codegen"), key, F.lit("0"), F.lit(""))
    asked = _rows(checks, key, _event_order(), _data("uid", F.lit(None) if payload is None else payload))
    return _two(told, asked, ["client_id", "params"], _Seen(), "uid string, seen_by_codegen boolean, payload string")


# ------------------------------------------------------------- D3, D4


class _Epochs(_InOrder):
    columns = ["fetch_id", "fetched_ms", "branch_id", "branch_changed", "epoch_ms"]

    def replay(self, key, rows, memory):
        branch, epoch = memory or (None, None)
        out = []
        for ms, _, data in rows:
            fetch, new = json.loads(data)
            changed = new is not None and branch is not None and new != branch
            if changed:
                epoch = ms
            branch = branch if new is None else new
            out.append((int(fetch), ms, new, changed, epoch))
        return out, (branch, epoch)

    def end_of(self, memory):
        return 0 if memory[0] is None else None  # the next fetch is compared with this branch


def branch_epochs_stream(fetches: DataFrame, stream: list[str]) -> DataFrame:
    """fetch_id, fetched_ms, branch_id, branch_changed and epoch_ms of every fetch, as ``branch_epochs``.

    ``fetches`` carry a watermark on ``ts``, the time of the fetch.  The next row of the stream with
    ``branch_changed`` says when a fetch became invalid, which no row can know before.
    """
    rows = _rows(fetches, [F.col(c) for c in stream], _fetch_order(), _data("fetch_id", "branch_id"))
    schema = "fetch_id long, fetched_ms long, branch_id string, branch_changed boolean, epoch_ms long"
    return _stateful(rows, stream, F.col("data"), _Epochs(), schema)


class _Fresh(_InOrder):
    """Specifications of one stream: a change of branch forgets those of all its keys."""

    columns = ["uid", "spec_state", "spec"]

    def replay(self, key, rows, memory):
        branch, specs = memory or (None, {})
        out = []
        for ms, order, data in rows:
            of, *values = json.loads(data)
            if order[0] == "0":
                new, spec = values
                if new is not None:
                    if branch is not None and new != branch:
                        specs = {}
                    branch = new
                specs[of] = (ms, spec)
            else:
                at, spec = specs.get(of, (None, None))
                if at is None or ms - at > FRESH_MS:
                    out.append((values[0], "miss", None))
                else:
                    out.append((values[0], "absent" if spec is None else "hit", spec))
        newest = rows[-1][0] if rows else max((at for at, _ in specs.values()), default=0)
        return out, (branch, {k: s for k, s in specs.items() if newest - s[0] <= FRESH_MS})

    def end_of(self, memory):
        branch, specs = memory
        if branch is not None:
            return None
        return max((at for at, _ in specs.values()), default=0) + FRESH_MS


def spec_asof_stream(events: DataFrame, fetches: DataFrame, stream: list[str], keys: list[str]) -> DataFrame:
    """``uid``, ``spec_state`` and ``spec`` in force at each event (D3), as ``spec_asof`` over ``branch_epochs``.

    ``keys`` name a specification inside a ``stream``.  ``fetches`` have ``ts``, ``fetch_id``,
    ``branch_id`` (null: nothing was found) and ``spec``; a change of branch in one key's fetch
    takes the specifications of all keys of the stream out of force.  Both inputs carry a watermark.
    """
    within = [F.col(c) for c in stream]
    of = F.to_json(F.array(*[F.col(c).cast("string") for c in keys]))
    told = _rows(fetches, within, _fetch_order(), _data(of, "branch_id", "spec"))
    asked = _rows(events, within, _event_order(), _data(of, "uid"))
    return _two(told, asked, stream, _Fresh(), "uid string, spec_state string, spec string")


# ---------------------------------------------------------------- D2


class _Asked(_InOrder):
    columns = ["key", "asked_ms"]

    def replay(self, key, rows, memory):
        asked, loaded = memory or (None, None)
        out = []
        for ms, order, _ in rows:
            if order[0] == "0":
                asked, loaded = None, ms
                continue
            fresh = loaded is not None and ms - loaded <= FRESH_MS
            waiting = asked is not None and ms - asked <= ANSWER_MS
            if not fresh and not waiting:
                asked = ms
                out.append((key[0], ms))
        return out, (asked, loaded)

    def end_of(self, memory):
        asked, loaded = memory
        return max(0 if asked is None else asked + ANSWER_MS, 0 if loaded is None else loaded + FRESH_MS)


def spec_requests_stream(events: DataFrame, answers: DataFrame, keys: list[str]) -> DataFrame:
    """The keys and ``asked_ms`` of every specification that has to be requested.

    A key is asked for when an event needs it, its last answer (found or not) is older than
    ``FRESH_MS``, and no request is open, which one stops being after ``ANSWER_MS`` without an answer.
    ``events`` may hold pre-extracted schemas too (D5).  Both inputs carry a watermark on ``ts``.
    """
    key = [F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("key")]
    told = _rows(answers, key, F.lit("0"), F.lit(""))
    asked = _rows(events, key, _event_order(), F.lit(""))
    found = _two(told, asked, ["key"], _Asked(), "key string, asked_ms long")
    shape = events.select(*keys).schema
    return found.select(F.from_json("key", shape).alias("k"), "asked_ms").select("k.*", "asked_ms")
