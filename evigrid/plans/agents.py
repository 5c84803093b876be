"""Tools that an agent may call, their audit, what it remembers, and the loop that a model drives."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_domain
from ..sources import files
from .runs import PolicyError, Sessions, check_tool, now, tenant_id

# Turns of a loop, days that a tactic holds, and rows that the lists of memory show.
MOST_TURNS, TACTIC_DAYS = 8, 14
SHOWN = {"run": 20, "tactic": 50, "client": 20}


@dataclass
class Memory:
    """Keyed notes of runs, domain tactics and clients: appended to a table, the latest of a key counts."""

    spark: SparkSession
    folder: str
    schema: str = "kind string, key string, content string, decay_at string, seq long, updated_at string"

    def put(self, kind: str, key: str, content: Mapping[str, Any], decay_at: str = "") -> None:
        seq = (self._rows().agg(F.max("seq")).first()[0] or 0) + 1
        row = (kind, key, json.dumps(content, sort_keys=True), decay_at, seq, now())
        self.spark.createDataFrame([row], self.schema).coalesce(1).write.mode("append").parquet(self.folder)

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder) if files.exists(self.folder) else self.spark.createDataFrame([], self.schema)

    def latest(self, kind: str, limit: int | None = None, at: str | None = None) -> DataFrame:
        """The latest note of each key, the last changed first; with ``at`` only those that have not decayed by then."""
        rows = self._rows().where(F.col("kind") == kind)
        last = rows.groupBy("key").agg(F.max_by(F.struct("content", "decay_at", "updated_at"), "seq").alias("r"), F.max("seq").alias("seq")).select("key", "r.*", "seq")
        if at is not None:
            last = last.where((F.col("decay_at") == "") | (F.col("decay_at") > at))
        return last.orderBy(F.desc("seq")).limit(SHOWN.get(kind, 20) if limit is None else limit)

    def get(self, kind: str, key: str) -> dict[str, Any] | None:
        row = self._rows().where((F.col("kind") == kind) & (F.col("key") == key)).orderBy(F.desc("seq")).first()
        return None if row is None else json.loads(row["content"])


@dataclass
class Toolbox:
    """Named tools behind the policy; every call that passes it is recorded, whether it fails or not."""

    tools: Mapping[str, Callable[[Mapping[str, Any]], Any]]
    sessions: Sessions
    memory: Memory
    tenant: str = "default"

    def invoke(self, session: str, tool: str, arguments: Mapping[str, Any]) -> dict[str, Any]:
        """Run a tool. Calls against the policy raise and leave no trace; failures are results with their error."""
        check_tool(tool, arguments)
        if tool not in self.tools:
            raise PolicyError(f"tool {tool} is not at hand")
        started = now()
        try:
            data, ok = self.tools[tool](arguments), True
        except Exception as error:
            data, ok = {"error": {"code": type(error).__name__, "message": str(error)[:500]}}, False
        event = {"tool": tool, "reason": arguments["reason"], "input": dict(arguments), "output": data, "status": "completed" if ok else "failed", "started_at": started, "completed_at": now()}
        self.sessions.add(session, self.tenant, "tool", tool, json.loads(json.dumps(event, default=str)))
        if ok:
            self._remember(session, tool, arguments, data)
        return {"ok": ok, "tenant_id": tenant_id(self.tenant), "session_id": session, "tool_name": tool, "data": data}

    def _remember(self, session: str, tool: str, arguments: Mapping[str, Any], data: Any) -> None:
        if tool in ("sync", "resume") and isinstance(data, Mapping) and data.get("run_id"):
            self.memory.put("run", str(data["run_id"]), {"session_id": session, "summary": data.get("summary", {}), "report": data.get("report", {})})
        if tool == "control_apply":
            domain = self.memory.spark.range(1).select(normalize_domain(F.lit(str(arguments["domain"])))).first()[0]
            until = (datetime.now(UTC) + timedelta(days=TACTIC_DAYS)).replace(microsecond=0).isoformat()
            self.memory.put("tactic", domain, {"action": arguments["action"], "reason": arguments["reason"], "value": arguments.get("prefix") or arguments.get("max_pages")}, until)


def nullable(schema: Mapping[str, Any]) -> dict[str, Any]:
    """A tool's argument schema in strict form: every property is required, those that were optional may be null."""
    need = set(schema.get("required", ()))
    out: dict[str, Any] = {}
    for name, rule in schema.get("properties", {}).items():
        rule = dict(rule)
        if name not in need:
            kinds = rule.get("type")
            kinds = list(kinds) if isinstance(kinds, list) else [kinds]
            rule["type"] = kinds if "null" in kinds else [*kinds, "null"]
            if "enum" in rule and None not in rule["enum"]:
                rule["enum"] = [*rule["enum"], None]
        out[name] = rule
    return {"type": "object", "properties": out, "required": list(out), "additionalProperties": False}


@dataclass
class Reply:
    """A model's answer: text, and tools to call before it goes on."""

    text: str = ""
    calls: list[tuple[str, dict[str, Any]]] = field(default_factory=list)


class ModelAdapter(Protocol):
    """What a language model has to offer to drive the loop."""

    def generate(self, goal: str, history: list[dict[str, Any]]) -> Reply: ...


def run_agent(model: ModelAdapter, box: Toolbox, session: str, goal: str, turns: int = MOST_TURNS, trace: Callable[[str, Mapping[str, Any]], None] | None = None) -> dict[str, Any]:
    """Let a model call tools until it asks for none, at most ``turns`` times; every turn is stored and traced."""
    history: list[dict[str, Any]] = []
    box.sessions.add(session, box.tenant, "turn", "user", goal)
    for turn in range(turns):
        reply = model.generate(goal, history)
        box.sessions.add(session, box.tenant, "turn", "assistant", reply.text)
        if trace:
            trace("turn", {"turn": turn, "text": reply.text, "calls": len(reply.calls)})
        if not reply.calls:
            return snapshot(box, session, "completed")
        for tool, arguments in reply.calls:
            try:
                result = box.invoke(session, tool, arguments)
            except PolicyError as error:
                result = {"ok": False, "tool_name": tool, "data": {"error": {"code": "policy", "message": str(error)}}}
            history.append({"tool": tool, "arguments": arguments, "result": result})
            if trace:
                trace("tool", result)
    return snapshot(box, session, "turns_used_up")


def snapshot(box: Toolbox, session: str, status: str) -> dict[str, Any]:
    """A session's state: calls by tool and end, the latest output of each tool, what failed, and what to do next."""
    rows = box.sessions.events(session, box.tenant, "tool")
    last = rows.groupBy("name").agg(F.max_by("content", "seq").alias("content"), F.count("*").alias("calls"), F.count_if(F.get_json_object("content", "$.status") == "failed").alias("failed")).orderBy("name").collect()
    latest = {r["name"]: json.loads(r["content"]) for r in last}
    risks = [f"{r['name']} failed {r['failed']} of {r['calls']} times" for r in last if r["failed"]]
    todo = [f"repeat {name}" for name, event in latest.items() if event["status"] == "failed"]
    if "export" not in latest and any(n in latest for n in ("sync", "resume")):
        todo.append("export")
    return {"session_id": session, "status": status, "calls": {r["name"]: r["calls"] for r in last}, "latest": {n: e["output"] for n, e in latest.items()}, "unresolved_risks": risks, "recommended_next_actions": todo}
