"""Site configurations: strict loading on the driver, before any plan is built."""

from __future__ import annotations

import json
import re
from dataclasses import MISSING, dataclass, field, fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

FIELDS = ("degree", "duration", "language", "tuition", "admission")
SCOPES = ("names-program", "page-wide")


class ConfigError(ValueError):
    """Says where in the file the fault is."""


@dataclass(frozen=True)
class Source:
    url: str
    route: str | None = None
    join: dict | None = None


@dataclass(frozen=True)
class Anchor:
    source: str
    pattern: str
    scope: str | None = None


@dataclass(frozen=True)
class Program:
    id: str
    name: str
    page: str
    extra_pages: list = field(default_factory=list)
    extra_sources: list = field(default_factory=list)
    lang_page: str | None = None
    adm_page: str | None = None
    tuition_page: str | None = None
    tuition_join: dict | None = None
    admission_join: dict | None = None
    field_anchors: dict = field(default_factory=dict)
    suppress_labels: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Site:
    uni_id: str
    programs: list
    sources: dict = field(default_factory=dict)
    anchors: dict = field(default_factory=dict)
    cookies: dict = field(default_factory=dict)


def _build(kind: type, raw, at: str):
    """A dataclass from a JSON object; unknown and missing keys are errors that name their place."""
    if not isinstance(raw, dict):
        raise ConfigError(f"{at}: an object is expected")
    known = {f.name: f for f in fields(kind)}
    if odd := sorted(set(raw) - set(known)):
        raise ConfigError(f"{at}: unknown keys {odd}")
    for name, f in known.items():
        if name not in raw and f.default is MISSING and f.default_factory is MISSING:
            raise ConfigError(f"{at}.{name}: missing")
        if name in raw and f.type == "str" and not isinstance(raw[name], str):
            raise ConfigError(f"{at}.{name}: text is expected")
        if name in raw and f.type in ("list", "dict") and not isinstance(raw[name], list if f.type == "list" else dict):
            raise ConfigError(f"{at}.{name}: {f.type} is expected")
    return kind(**raw)


def _pattern(text: str, at: str) -> None:
    try:
        groups = re.compile(text).groups
    except re.error as e:
        raise ConfigError(f"{at}: {e}") from e
    if not groups:
        raise ConfigError(f"{at}: a group is expected")


def parse_site(raw: dict) -> Site:
    """A checked site: references resolve, patterns compile, anchors off a programme's page state their scope."""
    site = _build(Site, raw, "site")
    sources = {k: _build(Source, v, f"sources.{k}") for k, v in site.sources.items()}
    anchors = {k: _build(Anchor, v, f"anchors.{k}") for k, v in site.anchors.items()}
    for k, a in anchors.items():
        _pattern(a.pattern, f"anchors.{k}.pattern")
        if a.scope is not None and a.scope not in SCOPES:
            raise ConfigError(f"anchors.{k}.scope: one of {SCOPES} is expected")
    programs, seen = [], set()
    for n, p in enumerate(site.programs):
        at = f"programs[{n}]"
        program = _build(Program, p, at)
        if program.id in seen:
            raise ConfigError(f"{at}.id: {program.id} is there already")
        seen.add(program.id)
        for s in program.extra_sources:
            if s not in sources:
                raise ConfigError(f"{at}.extra_sources: no source {s}")
        for f, a in program.field_anchors.items():
            if f not in FIELDS:
                raise ConfigError(f"{at}.field_anchors: no field {f}")
            if a not in anchors:
                raise ConfigError(f"{at}.field_anchors.{f}: no anchor {a}")
            where = sources[anchors[a].source].url if anchors[a].source in sources else anchors[a].source
            if where != program.page and anchors[a].scope is None:
                raise ConfigError(f"{at}.field_anchors.{f}: an anchor off the programme's page needs a scope")
        if odd := sorted(set(program.suppress_labels) - set(FIELDS)):
            raise ConfigError(f"{at}.suppress_labels: no fields {odd}")
        programs.append(program)
    return Site(site.uni_id, programs, sources, anchors, site.cookies)


def load_sites(folder: str) -> list[Site]:
    """All *.json of a folder in order of their names; a file is named by its uni_id."""
    out = []
    for path in sorted(Path(folder).glob("*.json")):
        try:
            site = parse_site(json.loads(path.read_text(encoding="utf-8")))
        except (ConfigError, json.JSONDecodeError) as e:
            raise ConfigError(f"{path.name}: {e}") from e
        if site.uni_id != path.stem:
            raise ConfigError(f"{path.name}: uni_id is {site.uni_id}")
        out.append(site)
    return out


def programs_table(spark: SparkSession, sites: list[Site]) -> DataFrame:
    rows = [(s.uni_id, p.id, p.name, p.page, p.extra_pages, p.lang_page, p.adm_page, p.tuition_page) for s in sites for p in s.programs]
    return spark.createDataFrame(rows, "uni_id string, program_id string, name string, page string, extra_pages array<string>, lang_page string, adm_page string, tuition_page string")


def suppressed_table(spark: SparkSession, sites: list[Site]) -> DataFrame:
    rows = [(p.id, f, label) for s in sites for p in s.programs for f, labels in p.suppress_labels.items() for label in labels]
    return spark.createDataFrame(rows, "program_id string, field string, label string")
