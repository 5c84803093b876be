"""Run settings: defaults, a JSON file over them, and the environment over both."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

# The usual limits of a crawl, and the paths that research tries on a site.
RESEARCH_PATHS = (
    "/search", "/directory", "/find-a-provider", "/find-a-doctor", "/provider-directory", "/verify-a-license", "/license-verification", "/license-lookup",
    "/physician-search", "/about", "/providers", "/team", "/staff", "/diagnosis", "/evaluations", "/evaluation", "/testing", "/autism", "/adhd", "/intake",
    "/referrals", "/contact", "/locations", "/telehealth", "/insurance",
)
LICENSE_PATHS = ("/verify-a-license", "/license-verification", "/license-lookup", "/physician-search", "/find-a-doctor")
MOST_DEPTH, USUAL_PAGES = 10, 30
FALSE_WORDS = ("0", "false", "no", "off", "n")


@dataclass
class Settings:
    """What a run is allowed to do."""

    max_depth: int = 2
    max_pages_per_domain: int = 30
    max_total_pages: int | None = None
    monitor_max_pages_per_domain: int = 12
    monitor_max_total_pages: int = 24
    monitor_max_depth: int = 1
    cache_ttl_hours: int = 24
    research_enabled: bool = True
    research_limit: int = 25
    research_min_score: int = 48
    browser_pages_per_domain: int = 5
    allowed_schemes: list[str] = field(default_factory=lambda: ["http", "https"])
    denylist: list[str] = field(default_factory=list)
    research_paths: list[str] = field(default_factory=lambda: list(RESEARCH_PATHS))
    extra_block_patterns: list[str] = field(default_factory=list)

    def denied_domains(self, more: str = "") -> list[str]:
        """The list of the settings and of a comma-separated text, lower case, without leading dots."""
        return sorted({d.strip().lower().lstrip(".") for d in [*self.denylist, *more.split(",")] if d.strip()})


def coerce(value: Any, default: Any) -> Any:
    """A value in the type of its default; blank values are the default."""
    if value is None or (isinstance(value, str) and not value.strip()):
        return default
    if isinstance(default, bool):
        return value if isinstance(value, bool) else str(value).strip().lower() not in FALSE_WORDS
    if isinstance(default, list):
        return [str(v).strip() for v in (value if isinstance(value, list) else str(value).split(",")) if str(v).strip()]
    return int(value)


def load(path: str | None = None, environment: Mapping[str, str] | None = None, prefix: str = "EVIGRID_") -> Settings:
    """Settings from a file, if it exists, and from variables such as ``EVIGRID_MAX_DEPTH``."""
    given = json.loads(Path(path).read_text(encoding="utf-8")) if path and Path(path).exists() else {}
    environment = os.environ if environment is None else environment
    usual = Settings()
    values = {}
    for f in fields(Settings):
        default = coerce(given.get(f.name), getattr(usual, f.name))
        values[f.name] = coerce(environment.get(prefix + f.name.upper()), default)
    return Settings(**values)


def page_budget(settings: Settings, policy_pages: int | None = None, override: int | None = None) -> int:
    """Pages of a domain: its policy, else the override, else the setting, else the usual number."""
    candidate = override if override and override > 0 else settings.max_pages_per_domain
    return policy_pages if policy_pages and policy_pages > 0 else (candidate if candidate > 0 else USUAL_PAGES)


def total_budget(settings: Settings, pages: int, override: int | None = None) -> int:
    candidate = override if override and override > 0 else settings.max_total_pages
    return max(1, min(candidate if candidate and candidate > 0 else pages, pages))


def depth(settings: Settings, policy_depth: int | None = None, override: int | None = None) -> int:
    candidate = override if override is not None and override >= 0 else settings.max_depth
    candidate = policy_depth if policy_depth is not None and policy_depth >= 0 else candidate
    return min(max(candidate, 0), MOST_DEPTH)


def research_paths(settings: Settings, source_type: str, detail_page: bool, browser_only: bool) -> list[str]:
    """Paths that research tries for a seed; none for detail pages, licence paths for boards only."""
    board = source_type == "licensing_board"
    if (detail_page and not board) or (browser_only and source_type in ("insurer_directory", "professional_directory")):
        return []
    paths = dict.fromkeys(p.strip().lower() for p in settings.research_paths)
    return [p for p in paths if p.startswith("/") and (board or p not in LICENSE_PATHS)]


def doctor(spark, folder: str, names: list[str]) -> list[tuple[str, bool, str]]:
    """Checks of a data folder: name, whether it holds, and what is wrong."""
    from .. import schemas

    found = []
    for name in names:
        try:
            wrong = schemas.drift(spark.read.parquet(f"{folder}/{name}"), name)
            found.append((name, not wrong, ", ".join(wrong)))
        except Exception as error:  # a missing or broken table is a finding, not a failure of the check
            found.append((name, False, str(error).splitlines()[0][:200]))
    return found
