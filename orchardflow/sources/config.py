"""Pipeline configuration: a YAML file to frozen dataclasses, with environment expansion and checks before anything is fetched."""

from __future__ import annotations

import dataclasses
import hashlib
import os
import re
import typing
from dataclasses import dataclass, field
from pathlib import Path

import yaml

from orchardflow.schemas import DATE_ORDERS, DECIMAL_SEPARATORS, FIELDS, REQUIRED
from orchardflow.sources.css import Selector, SelectorError

VERSION = 1
VARIABLE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)(?::-([^}]*))?\}")


class ConfigError(Exception):
    """The run cannot start."""


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise ConfigError(message)


def _within(name: str, value: float, low: float, high: float, above: bool = False) -> None:
    _require((value > low if above else value >= low) and value <= high, f"{name} must be {'above' if above else 'at least'} {low} and at most {high}, not {value}")


# The names, defaults and bounds of all settings below, which existing config files rely on.
@dataclass(frozen=True)
class Http:
    timeout_seconds: float = 10.0
    max_attempts: int = 3
    backoff_base_seconds: float = 0.5
    backoff_max_seconds: float = 30.0
    delay_seconds: float = 0.5
    user_agent: str = "orchardflow/1.0"
    respect_robots: bool = True

    def __post_init__(self) -> None:
        _within("http.timeout_seconds", self.timeout_seconds, 0, 300, above=True)
        _within("http.max_attempts", self.max_attempts, 1, 10)
        _within("http.backoff_base_seconds", self.backoff_base_seconds, 0, 60)
        _within("http.backoff_max_seconds", self.backoff_max_seconds, 0, 600)
        _within("http.delay_seconds", self.delay_seconds, 0, 60)
        _require(len(self.user_agent) >= 5, "http.user_agent must have 5 characters at least")
        _require(self.backoff_max_seconds >= self.backoff_base_seconds, "http.backoff_max_seconds must be at least backoff_base_seconds")


@dataclass(frozen=True)
class Browser:
    enabled: bool = True
    timeout_seconds: float = 20.0
    headless: bool = True

    def __post_init__(self) -> None:
        _within("browser.timeout_seconds", self.timeout_seconds, 0, 300, above=True)


@dataclass(frozen=True)
class Dedupe:
    key_fields: tuple[str, ...] = ("sku",)
    on_conflict: str = "keep_first"

    def __post_init__(self) -> None:
        _require(bool(self.key_fields), "dedupe.key_fields must name a field")
        unknown = [x for x in self.key_fields if x not in FIELDS]
        _require(not unknown, f"dedupe.key_fields names unknown fields {', '.join(unknown)}")
        _require(self.on_conflict in ("keep_first", "keep_last"), f"dedupe.on_conflict cannot be {self.on_conflict!r}")


@dataclass(frozen=True)
class Run:
    output_dir: str = "out"
    formats: tuple[str, ...] = ("csv", "json")
    state_file: str | None = None
    log_format: str = "text"
    log_level: str = "INFO"
    csv_encoding: str = "utf-8-sig"

    def __post_init__(self) -> None:
        _require(bool(self.formats) and set(self.formats) <= {"csv", "json"}, f"run.formats cannot be {list(self.formats)}")
        _require(self.log_format in ("text", "json"), f"run.log_format cannot be {self.log_format!r}")
        _require(self.log_level in ("DEBUG", "INFO", "WARNING", "ERROR"), f"run.log_level cannot be {self.log_level!r}")
        _require(self.csv_encoding in ("utf-8-sig", "utf-8"), f"run.csv_encoding cannot be {self.csv_encoding!r}")


@dataclass(frozen=True)
class Mapping:
    selector: str
    attr: str | None = None


@dataclass(frozen=True)
class Pagination:
    strategy: str = "none"
    next_selector: str | None = None
    page_param: str | None = None
    start_page: int = 1
    max_pages: int = 20

    def __post_init__(self) -> None:
        _require(self.strategy in ("none", "next_link", "page_param"), f"pagination.strategy cannot be {self.strategy!r}")
        _require(self.start_page >= 1, "pagination.start_page must be at least 1")
        _within("pagination.max_pages", self.max_pages, 1, 1000)
        _require(self.strategy != "next_link" or bool(self.next_selector), "pagination.strategy next_link needs next_selector")
        _require(self.strategy != "page_param" or bool(self.page_param), "pagination.strategy page_param needs page_param")


@dataclass(frozen=True)
class Source:
    id: str
    start_url: str
    record_selector: str
    fields: dict[str, Mapping]
    kind: str = "static"
    pagination: Pagination = field(default_factory=Pagination)
    date_order: str = "dmy"
    decimal_separator: str = "auto"
    default_currency: str | None = None
    wait_for_selector: str | None = None

    def __post_init__(self) -> None:
        _require(bool(re.fullmatch(r"[a-z0-9][a-z0-9_-]*", self.id)), f"source id {self.id!r} is not valid")
        at = f"sources.{self.id}"
        _require(self.kind in ("static", "browser"), f"{at}.kind cannot be {self.kind!r}")
        _require(self.start_url.startswith(("http://", "https://")), f"{at}.start_url must be an absolute http(s) URL")
        _require(self.date_order in DATE_ORDERS, f"{at}.date_order cannot be {self.date_order!r}")
        _require(self.decimal_separator in DECIMAL_SEPARATORS, f"{at}.decimal_separator cannot be {self.decimal_separator!r}")
        _require(self.default_currency is None or bool(re.fullmatch("[A-Z]{3}", self.default_currency)), f"{at}.default_currency must be three capitals")
        unknown, missing = sorted(self.fields.keys() - FIELDS.keys()), sorted(set(REQUIRED) - self.fields.keys())
        _require(not unknown, f"{at} maps unknown fields {', '.join(unknown)}")
        _require(not missing, f"{at} does not map the required fields {', '.join(missing)}")
        for where, selector in [("record_selector", self.record_selector), ("wait_for_selector", self.wait_for_selector), ("pagination.next_selector", self.pagination.next_selector), *((f"fields.{k}", m.selector) for k, m in self.fields.items())]:
            if selector is not None:
                try:
                    Selector(selector)
                except SelectorError as wrong:
                    raise ConfigError(f"{at}.{where}: {wrong}") from wrong
        _require(self.kind == "static" or bool(self.wait_for_selector), f"{at}: a browser source needs wait_for_selector")
        _require(self.kind == "browser" or not self.wait_for_selector, f"{at}: a static source cannot have wait_for_selector")


@dataclass(frozen=True)
class Config:
    sources: tuple[Source, ...]
    version: int = VERSION
    run: Run = field(default_factory=Run)
    http: Http = field(default_factory=Http)
    browser: Browser = field(default_factory=Browser)
    dedupe: Dedupe = field(default_factory=Dedupe)
    path: str = ""
    sha256: str = ""

    def __post_init__(self) -> None:
        _require(self.version == VERSION, f"config version {self.version} is not supported; this build reads version {VERSION}")
        _require(bool(self.sources), "sources must not be empty")
        ids = [s.id for s in self.sources]
        twice = sorted({x for x in ids if ids.count(x) > 1})
        _require(not twice, f"duplicate source ids: {', '.join(twice)}")

    def source(self, source_id: str) -> Source:
        found = [s for s in self.sources if s.id == source_id]
        if not found:
            raise KeyError(source_id)
        return found[0]

    def only(self, ids: list[str]) -> Config:
        """This config with the named sources, in config order."""
        unknown = [x for x in ids if x not in {s.id for s in self.sources}]
        _require(not unknown, f"unknown source ids: {', '.join(unknown)}")
        return dataclasses.replace(self, sources=tuple(s for s in self.sources if s.id in ids))


def expand(value, env):
    """``${VAR}`` and ``${VAR:-default}`` in the strings of a tree, keys apart; an unset variable without default is an error."""
    if isinstance(value, dict):
        return {k: expand(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [expand(v, env) for v in value]
    if not isinstance(value, str):
        return value

    def one(m: re.Match) -> str:
        found = env.get(m[1], m[2])
        _require(found is not None, f"environment variable {m[1]} is not set and has no default")
        return found

    return VARIABLE.sub(one, value)


def _made(kind, value, at: str):
    """A dataclass from a mapping: no unknown names, and values of the stated types."""
    if dataclasses.is_dataclass(kind):
        _require(isinstance(value, dict), f"{at or 'config'} must be a mapping")
        types = typing.get_type_hints(kind)
        allowed = {f.name: f for f in dataclasses.fields(kind) if not (kind is Config and f.name in ("path", "sha256"))}
        unknown = sorted(str(k) for k in value.keys() - allowed.keys())
        _require(not unknown, f"{at or 'config'} has unknown keys {', '.join(unknown)}")
        needed = [n for n, f in allowed.items() if f.default is dataclasses.MISSING and f.default_factory is dataclasses.MISSING and n not in value]
        _require(not needed, f"{at or 'config'} lacks {', '.join(needed)}")
        return kind(**{k: _made(types[k], v, f"{at}.{k}".lstrip(".")) for k, v in value.items()})
    origin, inner = typing.get_origin(kind), typing.get_args(kind)
    if origin is tuple:
        _require(isinstance(value, list), f"{at} must be a list")
        return tuple(_made(inner[0], v, f"{at}[{i}]") for i, v in enumerate(value))
    if origin is dict:
        _require(isinstance(value, dict), f"{at} must be a mapping")
        return {k: _made(inner[1], v, f"{at}.{k}") for k, v in value.items()}
    options = inner if inner else (kind,)
    if value is None and type(None) in options:
        return None
    if float in options and isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    _require(any(isinstance(value, o) for o in options) and not (isinstance(value, bool) and bool not in options), f"{at} has a value of the wrong type: {value!r}")
    return value


def load_config(path: str | Path, env: dict[str, str] | None = None) -> Config:
    """Read, expand and check a config file. Its hash is of the bytes on disk, before expansion."""
    try:
        raw = Path(path).read_bytes()
        tree = yaml.safe_load(raw.decode("utf-8"))
    except (OSError, UnicodeDecodeError, yaml.YAMLError) as wrong:
        raise ConfigError(f"{path}: {wrong}") from wrong
    _require(isinstance(tree, dict), f"{path} must be a mapping")
    made = _made(Config, expand(tree, os.environ if env is None else env), "")
    return dataclasses.replace(made, path=str(path), sha256=hashlib.sha256(raw).hexdigest())
