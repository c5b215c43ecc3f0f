"""Datasets: texts cut into chunks with metadata, searched by similarity."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from typing import Any

from ..errors import InvalidArgument
from ..plans import builder as b
from ..plans import schema as sc
from ..plans.ir import Expr
from .store import Store

MAX_QUERY, MAX_TOP_K = 512, 1000


def chunks(text: str, size: int = 1000) -> list[str]:
    """Paragraphs joined up to ``size`` characters; longer ones are cut at white space."""
    out: list[str] = []
    for part in re.split(r"\n\s*\n", text):
        part = part.strip()
        while len(part) > size:
            cut = part.rfind(" ", 1, size) if " " in part[1:size] else size
            out.append(part[:cut].strip())
            part = part[cut:].strip()
        if not part:
            continue
        if out and len(out[-1]) + len(part) + 2 <= size:
            out[-1] += "\n\n" + part
        else:
            out.append(part)
    return out


class Datasets:
    """Each dataset is a collection of chunks."""

    FIELDS = {"doc_id": sc.text().required(), "content_id": sc.integer().required(), "text": sc.text().required().indexed(sc.semantic_index())}

    def __init__(self, store: Store):
        self.store = store

    def _name(self, name: str) -> str:
        return f"dataset.{name}"

    def create(self, name: str) -> None:
        self.store.create(self._name(name), self.FIELDS)

    def list(self) -> list[str]:
        return [n.removeprefix("dataset.") for n in self.store.list() if n.startswith("dataset.")]

    def delete(self, name: str) -> None:
        self.store.drop(self._name(name))

    def upsert_file(self, name: str, doc_id: str, text: str, metadata: Mapping[str, Any] | None = None) -> str:
        """Replace a document's chunks; returns the handle of the write."""
        c = self.store.collection(self._name(name))
        if c.lsn():
            c.delete(b.field("doc_id").eq(doc_id))
        rows = [{"_id": f"{doc_id}#{i}", "doc_id": doc_id, "content_id": i, "text": t} | {k: v for k, v in (metadata or {}).items()} for i, t in enumerate(chunks(text))]
        return c.upsert(rows) if rows else ""

    def delete_file(self, name: str, doc_id: str) -> str:
        return self.store.collection(self._name(name)).delete(b.field("doc_id").eq(doc_id))

    def search(self, query: str, datasets: Iterable[str | tuple[str, Expr]], top_k: int = 10, filter: Expr | None = None) -> list[dict[str, Any]]:  # noqa: A002
        """The best chunks of all datasets; each may have a filter of its own beside the global one."""
        if not query or len(query) > MAX_QUERY:
            raise InvalidArgument(f"a query has 1 to {MAX_QUERY} characters")
        if not 1 <= top_k <= MAX_TOP_K:
            raise InvalidArgument(f"top_k must be 1 to {MAX_TOP_K}")
        found: list[dict[str, Any]] = []
        for d in datasets:
            name, own = d if isinstance(d, tuple) else (d, None)
            q = b.select("doc_id", "content_id", "text", _score=b.fn.semantic_similarity("text", query))
            for f in (filter, own):
                q = q.filter(f) if f is not None else q
            rows = self.store.collection(self._name(name)).query(q.sort(b.field("_score")).limit(top_k))
            found += [r | {"dataset": name} for r in rows]
        return sorted(found, key=lambda r: (-r["_score"], r["dataset"], r["_id"]))[:top_k]
