"""Edits against revisions, folded in the order in which they were asked for."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.canonical import canonical

#: Kinds of rows that fold_edits() gives out.
HEAD, EVENT, CONFLICT = "head", "event", "conflict"
_OUT = "kind string, request_id long, action string, revision long, status string, payload string, base_sha256 string, before string, after string, reason string"


class _Record:
    """One record's source, override, status and revision, as its edits change them."""

    def __init__(self, key: tuple) -> None:
        self.key, self.source, self.override, self.status, self.revision, self.known = key, None, {}, "active", 0, False

    @property
    def base(self) -> str:
        return hashlib.sha256(canonical(self.source or {}).encode()).hexdigest()

    def refusal(self, action: str, payload: dict | None, expected: int | None, base: str | None) -> str | None:
        """Why a request can't be taken, or None."""
        if self.source is None and not self.known:
            return "not_found"
        if expected != self.revision:
            return "revision"
        if action == "update":
            return "source_changed" if base != self.base else "no_payload" if payload is None else None
        if action == "retire":
            return "retired" if self.status == "retired" else None
        if action == "restore":
            return None if self.status == "retired" else "not_retired"
        return "action"

    def take(self, action: str, payload: dict | None) -> tuple[dict, dict]:
        """Make the change: the record before and after it. Of an override only what differs from the source is kept."""
        source = self.source or {}
        before = {**source, **self.override}
        if action == "update":
            merged = {**self.override, **(payload or {})}
            self.override = {k: v for k, v in merged.items() if self.source is None or k not in source or v != source[k]}
            if self.source is not None:
                self.override = {k: v for k, v in self.override.items() if not (v is None and source.get(k) is None)}
        else:
            self.status = "retired" if action == "retire" else "active"
        self.revision, self.known = self.revision + 1, True
        return before, {**source, **self.override}


def fold_edits(heads: DataFrame, requests: DataFrame, sources: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, kind, request_id, action, revision, status, payload, base_sha256, before, after, reason): what a batch of edits does.

    heads: keys, revision, payload, status; sources: keys, payload; requests: keys, request_id, action (update, retire,
    restore), payload, expected_revision, expected_base_sha256. Payloads are JSON objects. The requests of one key are taken in the
    order of request_id (null first), each against what those before it left, so a batch does what as many batches of one request
    would do. A request is refused, with a reason, if its revision is not the current one, the source has changed
    since (update), or its action doesn't go with the status. An event has the record before and after; heads come out for
    every key that has one. A key's rows go through one task as a sorted stream, never as one group.
    """
    text, none = F.lit(None).cast("string"), F.lit(None).cast("long")
    shape = [*keys, "_rank", "request_id", "action", "payload", "revision", "base", "status"]
    h = heads.select(*keys, F.lit(0).alias("_rank"), none.alias("request_id"), text.alias("action"), "payload", F.col("revision").cast("long").alias("revision"), text.alias("base"), "status")
    s = sources.select(*keys, F.lit(1).alias("_rank"), none.alias("request_id"), text.alias("action"), "payload", none.alias("revision"), text.alias("base"), text.alias("status"))
    r = requests.select(*keys, F.lit(2).alias("_rank"), F.col("request_id").cast("long").alias("request_id"), "action", "payload", F.col("expected_revision").cast("long").alias("revision"), F.col("expected_base_sha256").alias("base"), text.alias("status"))
    # A source without a head or a request has nothing to say.
    touched = h.select(*keys).unionByName(r.select(*keys)).distinct()
    rows = h.unionByName(s.join(touched, list(keys), "left_semi")).unionByName(r).select(*shape)
    ordered = rows.repartition(*keys).sortWithinPartitions(*keys, "_rank", "request_id")
    n = len(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [*keys, *(x.split()[0] for x in _OUT.split(", "))]
        current, out = None, []

        def head(x: _Record) -> None:
            if x.known:
                out.append((*x.key, HEAD, None, None, x.revision, x.status, canonical(x.override), x.base if x.source is not None else None, None, None, None))

        for pdf in batches:
            pdf = pdf.astype(object).where(pdf.notna(), None)
            for row in pdf.itertuples(index=False, name=None):
                key, (rank, request, action, payload, revision, base, status) = row[:n], row[n:]
                if current is None or current.key != key:
                    if current is not None:
                        head(current)
                    current = _Record(key)
                value = json.loads(payload) if payload is not None else None
                if rank == 0:
                    current.override, current.revision, current.status, current.known = value or {}, int(revision or 0), status or "active", True
                elif rank == 1:
                    current.source = value or {}
                elif why := current.refusal(action, value, revision, base):
                    out.append((*key, CONFLICT, request, action, current.revision, current.status, None, None, None, None, why))
                else:
                    before, after = current.take(action, value)
                    out.append((*key, EVENT, request, action, current.revision, current.status, canonical(current.override), current.base, canonical(before), canonical(after), None))
            done = pd.DataFrame(out, columns=columns)
            yield done.astype({"request_id": "Int64", "revision": "Int64"})
            out = []
        if current is not None:
            head(current)
            yield pd.DataFrame(out, columns=columns).astype({"request_id": "Int64", "revision": "Int64"})

    typed = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    return ordered.mapInPandas(run, f"{typed}, {_OUT}")


#: Characters of an error that are kept.
ERROR_CHARS = 500


def fold_progress(events: DataFrame, existing: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(keys, status, error): the state of each scope after its events, in their order.

    events: keys, status (done, error or pending), error and the order columns; existing: keys, status, error of before. The last event
    that is not pending decides; done clears an error. pending says that a scope was seen, and changes none that has a state. The
    fold is one aggregation, which combines before it shuffles, whatever order rows come in.
    """
    said = F.when(F.col("status").isin("done", "error"), F.struct(*order))
    last = events.groupBy(*keys).agg(F.max_by(F.struct("status", F.when(F.col("status") == "error", F.substring("error", 1, ERROR_CHARS)).alias("error")), said).alias("_last"))
    j = existing.select(*keys, F.col("status").alias("_status"), F.col("error").alias("_error")).join(last, list(keys), "full_outer")
    return j.select(*keys, F.coalesce("_last.status", "_status", F.lit("pending")).alias("status"), F.when(F.col("_last").isNotNull(), F.col("_last.error")).otherwise(F.col("_error")).alias("error"))
