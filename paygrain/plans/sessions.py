"""Sessions, model registry (UDX-07, MOD-14, SRT-04): small JSON records on the driver; data stay in their tables."""

from __future__ import annotations

import json
import os
import shutil
import uuid
from dataclasses import asdict, is_dataclass
from datetime import datetime, timezone
from pathlib import Path
from typing import Any

from pyspark.ml import PipelineModel


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="microseconds")


def _plain(x: Any) -> Any:
    """Scalars, paths and catalogues as JSON; tables and models are named, not stored."""
    if is_dataclass(x) and not isinstance(x, type):
        return {k: _plain(v) for k, v in asdict(x).items()}
    if isinstance(x, dict):
        return {str(k): _plain(v) for k, v in x.items()}
    if isinstance(x, (list, tuple, set, frozenset)):
        return [_plain(v) for v in x]
    return x if x is None or isinstance(x, (str, int, float, bool)) else f"<{type(x).__name__}>"


class Sessions:
    """Runs with a snapshot of their settings: create, close, list, compare, roll settings back, delete."""

    def __init__(self, root: str):
        self.root = Path(root)
        self.root.mkdir(parents=True, exist_ok=True)

    def create(self, settings: dict[str, Any], description: str = "") -> str:
        ident = f"{datetime.now(timezone.utc):%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
        self._write(ident, {"id": ident, "created": _now(), "status": "active", "description": description, "settings": _plain(settings)})
        (self.root / "current").write_text(ident)
        return ident

    def close(self, ident: str, status: str = "completed", summary: dict[str, Any] | None = None, error: str | None = None) -> None:
        d = self.get(ident)
        d |= {"status": status, "closed": _now(), "summary": _plain(summary or {})}
        if error:
            d["error"] = error[:2000]
        self._write(ident, d)

    def get(self, ident: str) -> dict[str, Any]:
        return json.loads((self.root / ident / "session.json").read_text())

    def current(self) -> str | None:
        p = self.root / "current"
        return p.read_text() if p.exists() else None

    def list(self) -> list[dict[str, Any]]:
        return sorted((self.get(p.parent.name) for p in self.root.glob("*/session.json")), key=lambda d: d["created"])

    def rollback(self, ident: str) -> dict[str, Any]:
        """The settings of a session, which becomes the current one. Tables are not touched."""
        d = self.get(ident)
        (self.root / "current").write_text(ident)
        return d["settings"]

    def compare(self, a: str, b: str) -> dict[str, tuple[Any, Any]]:
        """Settings and status that differ."""
        x, y = ({**self.get(s)["settings"], "status": self.get(s)["status"]} for s in (a, b))
        return {k: (x.get(k), y.get(k)) for k in sorted(x.keys() | y.keys()) if x.get(k) != y.get(k)}

    def delete(self, ident: str) -> None:
        self.get(ident)  # an unknown session is an error
        shutil.rmtree(self.root / ident)
        if self.current() == ident:
            os.remove(self.root / "current")

    def _write(self, ident: str, d: dict[str, Any]) -> None:
        at = self.root / ident
        at.mkdir(exist_ok=True)
        (at / "session.json.new").write_text(json.dumps(d, indent=1, ensure_ascii=False))
        os.replace(at / "session.json.new", at / "session.json")


class ModelRegistry:
    """Fitted pipelines under a root any executor can reach, with a JSON line per version."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.index = Path(self.root.removeprefix("file://")) / "models.jsonl"
        self.index.parent.mkdir(parents=True, exist_ok=True)

    def register(self, name: str, model: PipelineModel, figures: dict[str, float] | None = None, session: str | None = None) -> str:
        ident = f"{name}-{uuid.uuid4().hex[:8]}"
        model.write().overwrite().save(f"{self.root}/{ident}")
        with self.index.open("a") as f:
            f.write(json.dumps({"id": ident, "name": name, "at": _now(), "figures": figures or {}, "session": session}) + "\n")
        return ident

    def list(self, name: str | None = None) -> list[dict[str, Any]]:
        rows = [json.loads(x) for x in self.index.read_text().splitlines()] if self.index.exists() else []
        return [r for r in rows if name is None or r["name"] == name]

    def latest(self, name: str) -> str | None:
        rows = self.list(name)
        return max(rows, key=lambda r: r["at"])["id"] if rows else None

    def load(self, ident: str) -> PipelineModel:
        if ident not in {r["id"] for r in self.list()}:
            raise KeyError(ident)
        return PipelineModel.load(f"{self.root}/{ident}")
