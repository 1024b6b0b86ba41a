"""Job specifications: YAML, JSON or dicts into dataclasses, checked when loaded."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

ACTIONS = (
    "general", "general_number", "remove_mrn", "replace_har", "remove_age", "jitter_date_from_field", "jitter_date_randomly",
    "jitter_birth_date", "replace_with", "replace_minimumlengthword_with", "replace_strictly_with", "replace_ner_name",
    "surrogate_name", "surrogate_address", "keep", "remove",
)
_NEED_FIELDS = {"jitter_date_from_field", "jitter_birth_date", "replace_with", "replace_minimumlengthword_with", "replace_strictly_with"}


#: Further actions by name: (df, spec, text column, earlier findings) -> findings.
CUSTOM: dict[str, Callable] = {}


class ConfigError(ValueError):
    pass


def register_action(name: str, detector: Callable) -> None:
    """Makes a detector of one's own an action that jobs can name."""
    if name in ACTIONS:
        raise ConfigError(f"{name} is an action already")
    CUSTOM[name] = detector


def _strings(value: Any, trim: bool = True) -> list[str]:
    """A list, or a comma list, without nulls and empty parts."""
    parts = value if isinstance(value, list) else [] if value is None else str(value).split(",")
    return [x for x in ((str(p).strip() if trim else str(p)) for p in parts if p is not None) if x]


@dataclass(frozen=True)
class Spec:
    item: str
    action: str
    params: tuple[str, ...] = ()
    param_map: dict[str, str] = field(default_factory=dict)
    fields: tuple[str, ...] = ()
    info_types: tuple[str, ...] = ()

    @classmethod
    def of(cls, raw: dict, compat: bool = False) -> Spec:
        """compat: the fields keep the blanks that follow the commas, as names."""
        action, item = raw.get("action"), raw.get("itemName")
        if action not in ACTIONS and action not in CUSTOM:
            raise ConfigError(f"item {item!r}: unknown action {action!r}; there are {', '.join([*ACTIONS, *CUSTOM])}")
        if not item:
            raise ConfigError("a spec has no itemName")
        params = raw.get("actionParam")
        params = [str(p) for p in params] if isinstance(params, list) else [] if params is None else str(params).split(" ")
        pairs = raw.get("actionParamMap") or {}
        if isinstance(pairs, list):
            pairs = {k: v for one in pairs for k, v in one.items()}
        out = cls(str(item), action, tuple(p for p in params if p), {str(k): str(v) for k, v in pairs.items() if v is not None},
                  tuple(_strings(raw.get("fields"), not compat)), tuple(_strings(raw.get("infoTypes"))))
        if action in _NEED_FIELDS and not out.fields:
            raise ConfigError(f"item {item!r}: action {action} needs fields")
        return out


@dataclass(frozen=True)
class Job:
    name: str
    specs: tuple[Spec, ...]
    text_fields: tuple[str, ...] = ("note",)
    id_fields: tuple[str, ...] = ("id",)
    version: str = ""
    analytic: bool = True
    jitter_range: int = 30
    jitter_seed_field: str | None = None
    ner: bool = False
    annotator: bool = False
    external: bool = False
    external_types: tuple[str, ...] = ()
    external_specs: tuple[Spec, ...] = ()
    salt: str = "scrubline"
    person_field: str | None = None
    #: Words that are no known values; None: the library's own list.
    ignore_words: tuple[str, ...] | None = None

    @classmethod
    def of(cls, raw: dict, compat: bool = False) -> Job:
        if not isinstance(raw.get("spec", []), list):
            raise ConfigError("spec must be a list")
        ignored = raw.get("ignoreWords")
        if raw.get("ignoreWordsFile"):
            ignored = [*_strings(ignored), *(x.strip() for x in Path(raw["ignoreWordsFile"]).read_text(encoding="utf-8").splitlines())]
        days, given = raw.get("dateJitterRange"), raw.get("googleDlpInfoTypes")
        specs = [Spec.of({"action": "keep"} | s, compat) for s in given if isinstance(s, dict)] if isinstance(given, list) else []
        names = [n.upper() for s in specs for n in s.info_types] or _strings(given)
        return cls(
            str(raw.get("jobName", "job")), tuple(Spec.of(s, compat) for s in raw.get("spec") or []),
            tuple(_strings(raw.get("textFields")) or ["note"]), tuple(_strings(raw.get("textIdFields")) or ["id"]), str(raw.get("version", "")),
            bool(raw.get("analytic", True)), 30 if days is None else int(days), raw.get("dateJitterSeedField"), bool(raw.get("nerEnabled", False)),
            bool(raw.get("annotatorOutputEnabled", False)), bool(raw.get("googleDlpEnabled", False)), tuple(names),
            tuple(specs), str(raw.get("salt", "scrubline")), raw.get("personField"),
            None if ignored is None else tuple(x.lower() for x in _strings(ignored)),
        )

    @property
    def external_date_field(self) -> str | None:
        """Where the jitter of dates found by the external service stands: the first field of the DATE type's spec."""
        return next((s.fields[0] for s in reversed(self.external_specs) if s.fields and "DATE" in map(str.upper, s.info_types)), None)

    def with_overrides(self, text_fields: str | None = None, id_fields: str | None = None, external: bool | None = None) -> Job:
        from dataclasses import replace

        return replace(
            self, text_fields=tuple(_strings(text_fields)) or self.text_fields, id_fields=tuple(_strings(id_fields)) or self.id_fields,
            external=self.external if external is None else external,
        )


def load_jobs(source: str | Path | dict, compat: bool = False) -> list[Job]:
    """Jobs of a file (by path, else among the library's resources) or of a dict."""
    if not isinstance(source, dict):
        path = Path(source)
        if not path.exists():
            path = Path(__file__).parent.parent / "resources" / str(source)
        if not path.exists():
            raise ConfigError(f"no job file {source}")
        text = path.read_text(encoding="utf-8")
        if path.suffix == ".json":
            source = json.loads(text)
        else:
            import yaml

            try:
                source = yaml.safe_load(text)
            except yaml.YAMLError as e:
                raise ConfigError(f"{path.name} is no YAML: {e}") from e
    jobs = source.get("deidJobs", [source] if "spec" in source else [])
    if not jobs:
        raise ConfigError("no jobs")
    return [Job.of(j, compat) for j in jobs]
