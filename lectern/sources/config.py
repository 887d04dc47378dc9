"""Settings that the driver reads: sessions, environment files, and the specs of corrections. No table is behind them."""

from __future__ import annotations

import tomllib
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, datetime

#: The sources of a speech in the order in which they are tried.
SOURCES = ("pdf_en", "transcript_ai", "audio_en", "pdf_other", "video")
LEAST_CHARS = 200


@dataclass(frozen=True)
class Session:
    """One debate: its number, calendar, addresses and extraction settings."""

    id: int
    year: int
    name: str
    base_url: str
    slug_file: str
    ordinal: str = ""
    date_index: str = ""
    journal_dir: str = ""
    debate_dates: tuple[str, ...] = ()
    sources: tuple[str, ...] = SOURCES
    min_pdf_chars: int = LEAST_CHARS
    min_audio_chars: int = LEAST_CHARS

    def speaker_url(self, slug: str) -> str:
        return f"{self.base_url}/en/{self.id}/{slug}"


def known_sources(names) -> tuple[str, ...]:
    """Names of sources, which must all be known."""
    found = tuple(n.strip() for n in names if n.strip())
    wrong = [n for n in found if n not in SOURCES]
    if wrong:
        raise ValueError(f"unknown sources: {', '.join(wrong)}")
    return found


def load_session(text: str) -> Session:
    """A session from TOML. A zero for a least length stands for the default; missing sources mean all."""
    raw = tomllib.loads(text)
    missing = [k for k in ("id", "year", "name", "gadebate_base", "slug_file") if k not in raw]
    if missing:
        raise ValueError(f"a session needs {', '.join(missing)}")
    number = int(raw["id"])
    return Session(
        id=number,
        year=int(raw["year"]),
        name=str(raw["name"]),
        base_url=str(raw["gadebate_base"]).rstrip("/"),
        slug_file=str(raw["slug_file"]),
        ordinal=str(raw.get("ordinal") or ""),
        date_index=str(raw.get("date_index") or ""),
        journal_dir=str(raw.get("journal_dir") or f"data/unga{number}"),
        debate_dates=tuple(raw.get("debate_dates") or ()),
        sources=known_sources(raw.get("sources") or SOURCES),
        min_pdf_chars=int(raw.get("min_pdf_chars") or LEAST_CHARS),
        min_audio_chars=int(raw.get("min_audio_chars") or LEAST_CHARS),
    )


def parse_env(text: str) -> dict[str, str]:
    """KEY=VALUE lines: comments and lines without a key are passed over, `export ` and quotes around values go."""
    out: dict[str, str] = {}
    for line in text.splitlines():
        key, sign, value = line.strip().removeprefix("export ").partition("=")
        key, value = key.strip(), value.strip()
        if sign and key and not key.startswith("#"):
            out[key] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value
    return out


def merged_env(process: Mapping[str, str], file: Mapping[str, str], override: set[str]) -> dict[str, str]:
    """The process's variables with those of a file: listed keys overrule the process, others only fill gaps."""
    return {**file, **process, **{k: v for k, v in file.items() if k in override}}


_YES, _NO = {"1", "true", "yes", "on"}, {"0", "false", "no", "off"}


def read_setting(env: Mapping[str, str], name: str, kind: type, default, least=None):
    """A variable as bool, int, float or str; an empty one is the default. Errors name the variable."""
    raw = (env.get(name) or "").strip()
    if not raw:
        return default
    if kind is bool:
        if raw.lower() not in _YES | _NO:
            raise ValueError(f"{name} is neither yes nor no: {raw!r}")
        return raw.lower() in _YES
    try:
        value = kind(raw)
    except ValueError as error:
        raise ValueError(f"{name} is no {kind.__name__}: {raw!r}") from error
    if least is not None and value < least:
        raise ValueError(f"{name} must be {least} at least")
    return value


#: Spellings of how long a model's prompt cache lives.
CACHE_LIVES = {"off": {"off", "0", "false", "no", "none", "disabled"}, "5m": {"5m", "5min", "5", "300", "ephemeral"}, "1h": {"1h", "1hr", "60m", "3600"}}


def cache_life(raw: str | None) -> str:
    """off, 5m or 1h; an hour for anything else."""
    key = (raw or "1h").strip().lower()
    return next((life for life, names in CACHE_LIVES.items() if key in names), "1h")


def parse_moment(text: str) -> datetime:
    """ISO text in UTC; without a zone it is UTC."""
    found = datetime.fromisoformat(text.strip().replace(" ", "T"))
    return (found if found.tzinfo else found.replace(tzinfo=UTC)).astimezone(UTC)


def parse_fix(spec: str) -> tuple[datetime, datetime, str, str]:
    """`FROM..TO=Name|Title` as (start, end, name, title)."""
    window, sign, who = spec.partition("=")
    start, dots, end = window.partition("..")
    name, _, title = who.partition("|")
    if not (sign and dots and name.strip()):
        raise ValueError(f"expected FROM..TO=Name|Title: {spec}")
    found = parse_moment(start), parse_moment(end)
    if found[1] <= found[0]:
        raise ValueError(f"it ends before it begins: {spec}")
    return *found, name.strip(), title.strip()


def parse_cut(spec: str) -> tuple[float, str, str, str]:
    """`SECONDS=Name|Country|Title` as (start, name, country, title); country and title may be left out."""
    seconds, sign, rest = spec.partition("=")
    name, country, title = ([p.strip() for p in rest.split("|")] + ["", ""])[:3]
    try:
        start = float(seconds)
    except ValueError as error:
        raise ValueError(f"a cut begins with seconds: {spec}") from error
    if not sign or not name:
        raise ValueError(f"a cut needs =Name: {spec}")
    return start, name, country, title


def parse_run(text: str) -> int | None:
    """A run's number; `last` is -1, `all` None."""
    value = text.strip().casefold()
    try:
        return {"all": None, "last": -1}[value] if value in ("all", "last") else int(value)
    except ValueError as error:
        raise ValueError(f"a run is all, last or a number: {text}") from error


def parse_list(text: str) -> list[str]:
    """Comma-separated values without empty ones."""
    return [p.strip() for p in text.split(",") if p.strip()]
