"""Bounded windows of an HTTP event service behind an injectable transport [A1-A7, I4].

Count, fetch, count: the three must agree, or the window is tried again and then split at
its midpoint. A window that holds as many rows as the source returns at once is split, and so
is one that times out, to a lesser depth. What cannot be settled, whatever the error, is a
recorded gap, never a silent one.
"""

from __future__ import annotations

import hashlib
import json
import os
import random
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path
from typing import Any

from revisio.operators.windows import midpoint_split
from revisio.sources.landing import canonical_json

RETRY_STATUS = (429, 500, 502, 503, 504)
ATTEMPTS, RECONCILE, SAFE_ROWS, DEPTH, TIMEOUT_DEPTH, LIMIT = 4, 3, 10_000, 12, 3, 10_000


@dataclass
class Reply:
    status: int
    body: str = ""
    headers: Mapping[str, str] = field(default_factory=dict)


Transport = Callable[[str, Mapping[str, str]], Reply]


class SourceError(RuntimeError):
    """The source's answer cannot be used."""


class SourceTimeout(SourceError):
    """No answer in time; a smaller window may get one."""


@dataclass
class Client:
    transport: Transport
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    deadline_s: float = 180.0

    def request(self, what: str, params: Mapping[str, str], until: float) -> Reply:
        """Retries what may pass: some statuses and timeouts, with backoff, within the window's deadline."""
        last, slow = "no answer", False
        for turn in range(ATTEMPTS):
            if self.clock() >= until:
                raise SourceTimeout(f"deadline passed: {last}")
            try:
                reply = self.transport(what, params)
            except TimeoutError as error:
                last, wait, slow = str(error) or "timeout", min(8.0, 2.0**turn), True
            else:
                if reply.status not in RETRY_STATUS:
                    return reply
                last, slow = f"status {reply.status}", reply.status == 504
                after = reply.headers.get("Retry-After", "")
                wait = min(30.0, float(after)) if after.isdigit() else min(8.0, 2.0**turn) + random.uniform(0, 0.25)
            if turn + 1 < ATTEMPTS:
                self.sleep(min(wait, max(0.0, until - self.clock())))
        raise (SourceTimeout if slow else SourceError)(last)

    def count(self, params: Mapping[str, str], until: float) -> int:
        reply = self.request("count", params, until)
        try:
            value = json.loads(reply.body)
            n = value["count"] if isinstance(value, dict) else value
        except (ValueError, KeyError) as error:
            raise SourceError("malformed count") from error
        if reply.status != 200 or isinstance(n, bool) or not isinstance(n, int) or n < 0:
            raise SourceError("malformed count")
        return n

    def features(self, params: Mapping[str, str], until: float) -> list[dict[str, Any]]:
        reply = self.request("query", {**params, "limit": str(LIMIT)}, until)
        if reply.status == 204:
            return []
        try:
            body = json.loads(reply.body)
        except ValueError as error:
            raise SourceError("malformed response") from error
        rows = body.get("features") if isinstance(body, dict) and body.get("type") == "FeatureCollection" else None
        if reply.status != 200 or not isinstance(rows, list) or not all(isinstance(r, dict) for r in rows):
            raise SourceError("not a feature collection")
        return rows

    def window(self, params: Mapping[str, str], start: datetime, end: datetime, window_id: str = "w0", depth: int = 0) -> tuple[list[tuple[dict, str, datetime]], list[dict[str, Any]]]:
        """(features with window id and fetch time, audits) of a window and, if it must be split, of its halves."""
        until = self.clock() + self.deadline_s
        asked = {**params, "starttime": start.isoformat(), "endtime": end.isoformat()}
        audit: dict[str, Any] = {"window_id": window_id, "starttime": start.isoformat(), "endtime": end.isoformat()}
        reason, deepest = "counts disagree", DEPTH
        try:
            for turn in range(1, RECONCILE + 1):
                before = self.count(asked, until)
                if before >= SAFE_ROWS:
                    reason = "too many rows"
                    break
                rows = self.features(asked, until)
                after = self.count(asked, until)
                at = datetime.now(UTC)
                if before == len(rows) == after:
                    return [(r, window_id, at) for r in rows], [audit | {"status": "reconciled", "attempts": turn, "count_before": before, "returned_rows": len(rows), "count_after": after}]
        except SourceTimeout as error:
            reason, deepest = f"timeout: {error}", TIMEOUT_DEPTH
        except SourceError as error:
            return [], [audit | {"status": "unresolved", "reason": str(error)}]
        try:
            if depth >= deepest:
                raise ValueError("split depth reached")
            halves = midpoint_split(start, end)
        except ValueError as error:
            return [], [audit | {"status": "unresolved", "reason": f"{reason}; {error}"}]
        out, audits = [], [audit | {"status": "split", "reason": reason}]
        for k, (a, b) in enumerate(halves):
            some, told = self.window(params, a, b, f"{window_id}.{k}", depth + 1)
            out += some
            audits += told
        return out, audits


def _replace(path: Path, text: str) -> None:
    whole = path.with_name(f".{path.name}.tmp")
    whole.write_text(text, encoding="utf-8")
    os.replace(whole, path)


def begin(folder: Path, logical_id: str, attempt_id: str, **plan: Any) -> dict[str, Any]:
    """A new attempt folder whose manifest says `running` [A6]; a folder that exists is refused. plan: what is asked for."""
    folder.mkdir(parents=True, exist_ok=False)
    manifest = {"attempt_id": attempt_id, "logical_batch_id": logical_id, "status": "running", **plan}
    _replace(folder / "manifest.json", json.dumps(manifest, indent=1, sort_keys=True, default=str))
    return manifest


def publish(folder: Path, logical_id: str, attempt_id: str, rows: list[tuple[dict, str, datetime]], audits: list[dict[str, Any]], **plan: Any) -> dict[str, Any]:
    """Write events.jsonl and manifest.json, each whole or not at all; a capture with gaps is failed and has no rows.

    The folder is new, or holds the running manifest that `begin` wrote for the same attempt.
    """
    gaps = [a for a in audits if a["status"] == "unresolved"]
    if folder.exists():
        begun = json.loads((folder / "manifest.json").read_text(encoding="utf-8"))
        if (begun.get("status"), begun.get("attempt_id")) != ("running", attempt_id):
            raise FileExistsError(f"{folder} holds another capture")
    else:
        begin(folder, logical_id, attempt_id, **plan)
    lines = [] if gaps else [
        canonical_json({"source_feature": f, "metadata": {"logical_batch_id": logical_id, "attempt_id": attempt_id, "window_id": w, "fetched_at": at.isoformat(), "payload_hash": hashlib.sha256(canonical_json(f).encode()).hexdigest(), "parser_version": "1"}})
        for f, w, at in rows
    ]
    manifest = {**plan, "attempt_id": attempt_id, "logical_batch_id": logical_id, "status": "failed" if gaps else "complete", "coverage_gaps": gaps, "window_audit": audits, "events_file": "events.jsonl", "source_rows_returned": len(rows), "raw_rows_written": len(lines)}
    _replace(folder / "events.jsonl", "".join(x + "\n" for x in lines))
    _replace(folder / "manifest.json", json.dumps(manifest, indent=1, sort_keys=True, default=str))
    return manifest


def save_checkpoint(path: Path, payload: dict[str, Any]) -> None:
    body = canonical_json(payload)
    path.with_suffix(".tmp").write_text(json.dumps({"sha256": hashlib.sha256(body.encode()).hexdigest(), "payload": payload}), encoding="utf-8")
    os.replace(path.with_suffix(".tmp"), path)


def load_checkpoint(path: Path, **expected: Any) -> dict[str, Any] | None:
    """A child capture whose digest and expected fields agree; anything else is as if it were not there."""
    try:
        wrapped = json.loads(path.read_text(encoding="utf-8"))
        payload = wrapped["payload"]
        whole = hashlib.sha256(canonical_json(payload).encode()).hexdigest() == wrapped["sha256"]
    except (OSError, ValueError, KeyError, TypeError):
        return None
    return payload if whole and all(payload.get(k) == v for k, v in expected.items()) else None


def child_capture(root: Path, params: Mapping[str, str], start: datetime, end: datetime) -> dict[str, Any] | None:
    """The newest usable checkpoint of a child window below root, of this attempt or an earlier one [A7].

    Usable: digest and request agree, the audits cover the window without a gap, each count
    equals the rows that name its window, and no row was fetched before its window ended or
    lacks a time zone. Anything else is as if it were not there.
    """
    found = []
    for path in sorted(root.glob("**/*.checkpoint.json")):
        payload = load_checkpoint(path, params=dict(params), starttime=start.isoformat(), endtime=end.isoformat())
        if payload and not _checkpoint_problem(payload, start, end):
            found.append((payload["fetched_at"], str(path), payload))
    return max(found, key=lambda x: x[:2])[2] if found else None


def _checkpoint_problem(payload: dict[str, Any], start: datetime, end: datetime) -> str | None:
    try:
        audits, rows = payload["window_audit"], payload["rows"]
        leaves = sorted((a for a in audits if a["status"] == "reconciled"), key=lambda a: a["starttime"])
        if not leaves or any(a["status"] not in ("reconciled", "split") for a in audits):
            return "unsettled windows"
        edges = [datetime.fromisoformat(a[k]) for a in leaves for k in ("starttime", "endtime")]
        if edges[0] != start or edges[-1] != end or edges[1:-1:2] != edges[2::2]:
            return "windows do not cover the child"
        told = {a["window_id"]: a["returned_rows"] for a in leaves}
        if len(told) != len(leaves) or any(not a["count_before"] == a["returned_rows"] == a["count_after"] for a in leaves):
            return "counts disagree"
        seen: dict[str, int] = {}
        for r in rows:
            seen[r["window_id"]] = seen.get(r["window_id"], 0) + 1
            if datetime.fromisoformat(r["fetched_at"]).utcoffset() is None:
                return "a fetch time without a zone"
        if seen != {k: n for k, n in told.items() if n} or datetime.fromisoformat(payload["fetched_at"]).utcoffset() is None:
            return "rows disagree with the audit"
    except (KeyError, TypeError, ValueError, IndexError) as error:
        return f"malformed: {error}"
    return None
