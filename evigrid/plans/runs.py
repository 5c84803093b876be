"""Runs of the record pipeline: stages with resume, operator controls, tool policy and session memory.

State documents are small JSON files beside the tables, replaced as a whole; tables are Parquet
folders of a run, one per stage, so a stage that is done is never computed again.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files

# The stages in order, and how many interventions a run keeps and shows.
STAGES = ("seed_ingest", "crawl", "extract", "resolve", "score", "qa", "export")
KEPT_INTERVENTIONS, SHOWN_INTERVENTIONS = 200, 10
#: Older versions of the controls that stay readable, and how much of an error's text is kept.
KEPT_VERSIONS, ERROR_LENGTH = 20, 240


def now() -> str:
    return datetime.now(UTC).replace(microsecond=0).isoformat()


def _replace(path: str, payload: Mapping[str, Any]) -> None:
    files.write_bytes(path, json.dumps(payload, indent=2).encode())


def _load(path: str) -> dict[str, Any] | None:
    return json.loads(files.read_bytes(path)) if files.exists(path) else None


def tenant_id(raw: str) -> str:
    """Lower-case letters, digits, hyphens and underscores; ``default`` where nothing is left."""
    return re.sub(r"[^a-z0-9_-]", "-", raw.strip().lower()).strip("-") or "default"


class Run:
    """One run below ``base/<tenant>/<run_id>``; reopened, it goes on after its last finished stage."""

    def __init__(self, base: str, run_id: str, tenant: str = "default", stages: tuple[str, ...] = STAGES):
        self.folder, self.stages = files.join(base, tenant_id(tenant), run_id), stages
        self.path = files.join(self.folder, "run.json")
        self.state = _load(self.path)
        if self.state is None:
            self.state = {"run_id": run_id, "status": "running", "created_at": now(), "last_error": {}, "stages": {s: {"status": "pending"} for s in stages}}
            self._save()

    def _save(self) -> None:
        self.state["updated_at"] = now()
        self.state["recovery_pointer"] = self.next_stage() or "done"
        _replace(self.path, self.state)

    def next_stage(self) -> str | None:
        """The first stage that isn't completed."""
        return next((s for s in self.stages if self.state["stages"][s]["status"] != "completed"), None)

    def table(self, spark: SparkSession, stage: str) -> DataFrame:
        return spark.read.parquet(files.join(self.folder, stage))

    def execute(self, spark: SparkSession, steps: Mapping[str, Callable[[SparkSession, Run], DataFrame]]) -> dict[str, Any]:
        """Run what is left, stage by stage; a failure is recorded with its stage and raised."""
        while (stage := self.next_stage()) is not None:
            entry = self.state["stages"][stage]
            entry |= {"status": "running", "started_at": entry.get("started_at") or now()}
            self._save()
            try:
                steps[stage](spark, self).write.mode("overwrite").parquet(files.join(self.folder, stage))
            except Exception as error:
                entry |= {"status": "failed", "completed_at": now(), "error": str(error)[:500]}
                self.state |= {"status": "failed", "last_error": {"stage": stage, "message": str(error)[:500], "at": now()}}
                self._save()
                raise
            entry |= {"status": "completed", "completed_at": now()}
            self._save()
        self.state |= {"status": "completed", "last_error": {}}
        self._save()
        return self.state


class Controls:
    """Operator controls of a run's domains and the log of interventions.

    The document has versions, one file each. A change is made on the newest and written as the next,
    which fails if another writer was first; then it is made again on theirs, so no change is lost.
    """

    def __init__(self, path: str):
        self.path = path
        self.state = self._newest()[1]

    def _newest(self) -> tuple[int, dict[str, Any]]:
        folder, name = self.path.rsplit("/", 1) if "/" in self.path else (".", self.path)
        while True:
            found = [int(n.rsplit(".v", 1)[1]) for n in files.names(folder) if re.fullmatch(re.escape(name) + r"\.v\d{8}", n)]
            if not found:
                return 0, _load(self.path) or {"domains": {}, "interventions": []}
            state = _load(f"{self.path}.v{max(found):08d}")
            if state is not None:
                return max(found), state

    def _change(self, change: Callable[[dict[str, Any]], Any]) -> Any:
        """Make a change on the newest version; what ``change`` gives, and nothing is written where that is False."""
        while True:
            version, state = self._newest()
            result = change(state)
            if result is False:
                self.state = state
                return False
            if files.create_bytes(f"{self.path}.v{version + 1:08d}", json.dumps(state, indent=2).encode()):
                if version > KEPT_VERSIONS:
                    files.remove(f"{self.path}.v{version - KEPT_VERSIONS:08d}")
                self.state = state
                return result

    def refresh(self) -> dict[str, Any]:
        """The newest version, with what other writers changed."""
        self.state = self._newest()[1]
        return self.state

    def observe(self, domain: str, **runtime: Any) -> None:
        """Note what a crawl of the domain does; controls that operators set stay."""
        self._change(lambda state: self._observed(state, domain, runtime))

    @staticmethod
    def _observed(state: dict[str, Any], domain: str, runtime: Mapping[str, Any]) -> None:
        record = state.setdefault("runtime", {}).setdefault(domain, {"status": "idle", "last_error": ""})
        record |= {**runtime, "updated_at": now()}

    def succeeded(self, domain: str, **runtime: Any) -> None:
        """A page came: the error text is cleared, counts of failures stay."""
        self.observe(domain, **runtime, last_error="")

    def once(self, key: str, action: str, domain: str, reason: str) -> bool:
        """Log an automatic intervention unless one of this key was logged for the domain before."""
        return self._change(lambda state: self._first(state, key, action, domain, reason))

    def _first(self, state: dict[str, Any], key: str, action: str, domain: str, reason: str) -> bool:
        keys = state.setdefault("keys", {}).setdefault(domain, [])
        if key in keys:
            return False
        keys.append(key)
        self._log(state, action, domain, reason, "auto")
        return True

    def escalate(self, domain: str, reason: str, mode: str, on_block: bool, browser_pages: int, pages_left: int) -> bool:
        """Ask for a browser once a domain, where its policy allows one and pages are left for it."""
        if mode == "http_only" or not on_block or min(browser_pages, pages_left) <= 0:
            return False

        def change(state: dict[str, Any]) -> bool:
            asked = state.get("runtime", {}).get(domain, {}).get("browser_escalated")
            if asked or not self._first(state, f"browser:{reason}", "browser_escalation", domain, reason):
                return False
            self._observed(state, domain, {"browser_escalated": True, "last_error": reason})
            return True

        return self._change(change)

    def finalise(self, status: str, replace_running_with: str = "", message: str = "") -> None:
        """End a run: domains still running take the status, and the message where they have no error."""
        def change(state: dict[str, Any]) -> None:
            state |= {"status": status, "current_domain": ""}
            for record in state.get("runtime", {}).values():
                if record.get("status") == "running":
                    record |= {"status": replace_running_with or status, "last_error": record.get("last_error") or message[:ERROR_LENGTH], "updated_at": now()}

        self._change(change)

    def limits(self, domain: str, base: Mapping[str, int]) -> dict[str, Any]:
        """What holds for a domain now: its page limits under a cap, its prefixes, and whether it stops."""
        record = self.state["domains"].get(domain, {})
        cap = record.get("max_pages_per_domain")
        return {
            **{k: min(v, max(1, int(cap))) if cap else v for k, v in base.items()}, "suppressed_prefixes": record.get("suppressed_prefixes", []),
            "stop": bool(record.get("stop_requested") or record.get("quarantined")), "quarantined": bool(record.get("quarantined")),
        }

    @staticmethod
    def _log(state: dict[str, Any], action: str, domain: str, reason: str, source: str) -> None:
        state["interventions"].append({"at": now(), "domain": domain, "action": action, "reason": reason, "source": source})
        del state["interventions"][:-KEPT_INTERVENTIONS]

    def apply(self, action: str, domain: str, reason: str, source: str = "operator", prefix: str = "", max_pages: int = 0) -> None:
        """Quarantine, suppress a prefix, cap, stop or clear a domain, and log it."""
        self._change(lambda state: self._applied(state, action, domain, reason, source, prefix, max_pages))

    def _applied(self, state: dict[str, Any], action: str, domain: str, reason: str, source: str, prefix: str, max_pages: int) -> None:
        record = state["domains"].setdefault(domain, {})
        if action == "quarantine-seed":
            record |= {"quarantined": True, "quarantine_reason": reason}
        elif action == "suppress-prefix":
            record["suppressed_prefixes"] = sorted({*record.get("suppressed_prefixes", []), clean_prefix(prefix)})
        elif action == "cap-domain":
            record["max_pages_per_domain"] = max_pages
        elif action == "stop-domain":
            record["stop_requested"] = True
        elif action == "clear-domain":
            state["domains"].pop(domain)
        else:
            raise ValueError(f"unknown action: {action}")
        self._log(state, action, domain, reason, source)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The controls as a small table, to be joined with pages or a stream."""
        rows = [
            (d, bool(r.get("quarantined")), bool(r.get("stop_requested")), r.get("max_pages_per_domain"), r.get("suppressed_prefixes", []))
            for d, r in sorted(self.state["domains"].items())
        ]
        return spark.createDataFrame(rows, "domain string, quarantined boolean, stop_requested boolean, max_pages int, suppressed_prefixes array<string>")

    def summary(self) -> dict[str, Any]:
        domains = self.state["domains"]
        return {
            "quarantined_domains": [d for d, r in domains.items() if r.get("quarantined")], "stopped_domains": [d for d, r in domains.items() if r.get("stop_requested")],
            "capped_domains": {d: r["max_pages_per_domain"] for d, r in domains.items() if r.get("max_pages_per_domain")},
            "recent_interventions": self.state["interventions"][-SHOWN_INTERVENTIONS:],
        }


def clean_prefix(raw: str) -> str:
    """A leading slash, and a trailing one unless the last part looks like a file."""
    p = "/" + raw.strip().lower().lstrip("/")
    return p if p.endswith("/") or "." in p.rsplit("/", 1)[-1] else p + "/"


class PolicyError(ValueError):
    """A tool call that isn't allowed."""


# Tools and control actions that an agent may use, and its limits.
TOOLS = ("doctor", "sync", "resume", "status", "search", "control_show", "control_apply", "export", "sql")
ACTIONS = ("quarantine-seed", "suppress-prefix", "cap-domain", "stop-domain", "clear-domain")
MOST_SEEDS, MOST_EXPORTED = 3, 25
USUAL_SEEDS, USUAL_EXPORTED = 2, 15


def check_tool(tool: str, arguments: Mapping[str, Any]) -> None:
    """Raise ``PolicyError`` unless the call is allowed."""
    def need(holds: bool, message: str) -> None:
        if not holds:
            raise PolicyError(message)

    need(tool in TOOLS, f"tool {tool} is not known")
    need(bool(str(arguments.get("reason") or "").strip()), "a reason is needed")
    if tool in ("sync", "resume"):
        need(1 <= int(arguments.get("limit") or USUAL_EXPORTED) <= MOST_EXPORTED, f"export limits go from 1 to {MOST_EXPORTED}")
    if tool == "sync":
        need(str(arguments.get("crawl_mode") or "refresh").strip().lower() == "refresh", "only refresh runs are allowed")
        need(1 <= int(arguments.get("max") or USUAL_SEEDS) <= MOST_SEEDS, f"seed limits go from 1 to {MOST_SEEDS}")
    if tool == "control_apply":
        action = str(arguments.get("action") or "").strip()
        need(action in ACTIONS, f"control action {action} is not known")
        need(bool(str(arguments.get("domain") or "").strip()), "a domain is needed")
        need(action != "suppress-prefix" or bool(str(arguments.get("prefix") or "").strip()), "a prefix is needed")
        need(action != "cap-domain" or int(arguments.get("max_pages") or 0) > 0, "a positive page cap is needed")
    if tool == "sql":
        need(str(arguments.get("query") or "").strip().lower().startswith(("select", "with", "pragma")), "only read-only statements are run")


@dataclass
class Sessions:
    """Append-only store of an agent's turns and tool events as Parquet, read by tenant."""

    spark: SparkSession
    folder: str
    schema: str = "session_id string, tenant_id string, seq long, kind string, name string, content string, created_at string"
    _seq: int = field(default=0, repr=False)

    def add(self, session: str, tenant: str, kind: str, name: str, content: Any) -> None:
        self.add_all(session, tenant, [(kind, name, content)])

    def add_all(self, session: str, tenant: str, entries: list[tuple[str, str, Any]]) -> None:
        """Append entries (kind, name, content) in order, in one file."""
        rows = [(session, tenant_id(tenant), self._next(), kind, name, x if isinstance(x, str) else json.dumps(x, sort_keys=True), now()) for kind, name, x in entries]
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.folder)

    def _next(self) -> int:
        """Numbers go up with time and from what the store holds, so order survives reopening."""
        if not self._seq and files.exists(self.folder):
            self._seq = self.spark.read.schema(self.schema).parquet(self.folder).agg(F.max("seq")).first()[0] or 0
        self._seq = max(self._seq + 1, time.time_ns())
        return self._seq

    def events(self, session: str, tenant: str, kind: str) -> DataFrame:
        """All entries of a kind; only the tenant's own."""
        rows = self.spark.read.schema(self.schema).parquet(self.folder)
        return rows.where((rows.session_id == session) & (rows.tenant_id == tenant_id(tenant)) & (rows.kind == kind))

    def last(self, session: str, tenant: str, kind: str, n: int) -> DataFrame:
        """The last n entries of a kind, oldest first; only the tenant's own."""
        from .query import tail

        return tail(self.events(session, tenant, kind), "seq", n)

    def latest_session(self, tenant: str) -> str | None:
        """The session that was added to last; None without one."""
        rows = self.spark.read.schema(self.schema).parquet(self.folder)
        row = rows.where(rows.tenant_id == tenant_id(tenant)).orderBy(F.desc("seq")).first()
        return None if row is None else row["session_id"]


def report(kind: str, payload: Any, ok: bool = True) -> str:
    """A versioned envelope for a command's result."""
    return json.dumps({"schema_version": 1, "command": kind, "status": "ok" if ok else "error", "data" if ok else "error": payload}, sort_keys=True)
