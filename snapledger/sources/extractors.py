"""Hook for page readers: the caller brings the engine, Spark brings the pages.

An engine factory is called once per task. It returns ``read(page: dict) -> dict`` (the payload of that page) or, registered
as ``batched``, ``read(pages: list[dict]) -> list[dict]``, so that an engine may work on many pages at once. A batch that
raises is read again page by page; a page that raises becomes a failure row and never fails the job.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Reader = Callable[[list[dict]], list[dict | None]]
Factory = Callable[..., Reader]
_FACTORIES: dict[str, Factory] = {}

RESULT = "payload string, failed boolean, error string"
#: Pages that an engine gets at a time.
PAGES = 64


def register(name: str, batched: bool = False) -> Callable[[Callable], Callable]:
    def add(factory: Callable) -> Callable:
        def rowwise(**options) -> Reader:
            read = factory(**options)
            return lambda pages: [read(page) for page in pages]

        _FACTORIES[name] = factory if batched else rowwise
        return factory

    return add


def available() -> list[str]:
    return sorted(_FACTORIES)


def get_extractor(name: str) -> Factory:
    if name not in _FACTORIES:
        raise ValueError(f"no extractor {name!r}; there are: {', '.join(available())}")
    return _FACTORIES[name]


def extract(pages: DataFrame, name: str, keep: tuple[str, ...] = ("roll_id", "page", "band"), **options) -> DataFrame:
    """``pages`` through one engine; filter before calling, since the engine is the expensive step."""
    factory = get_extractor(name)
    kept = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep]

    def run(batches: Iterator):
        read = factory(**options)
        for batch in batches:
            found = [x for low in range(0, len(batch), PAGES) for x in _read(read, batch.iloc[low:low + PAGES].to_dict("records"))]
            payloads, failed, errors = zip(*found, strict=True) if found else ((), (), ())
            yield batch[list(keep)].assign(payload=list(payloads), failed=list(failed), error=list(errors))

    return pages.mapInPandas(run, ", ".join(kept) + ", " + RESULT)


def _read(read: Reader, pages: list[dict]) -> list[tuple[str | None, bool, str | None]]:
    """(payload, failed, error) of each page."""
    try:
        found = read(pages)
        if len(found) != len(pages):
            raise ValueError(f"{len(found)} payloads for {len(pages)} pages")
        return [(json.dumps(x or {}, ensure_ascii=False), False, None) for x in found]
    except Exception as e:  # noqa: BLE001 - one bad page must not end the job
        if len(pages) == 1:
            return [(None, True, f"{type(e).__name__}: {e}")]
        return [x for page in pages for x in _read(read, [page])]


def extract_by_language(
    pages: DataFrame, routes: dict[str, str], default: str, language: str = "language_code", **options
) -> DataFrame:
    """Each language through its engine; languages without a route take the default one."""
    engines: dict[str, list[str]] = {}
    for code, name in routes.items():
        engines.setdefault(name, []).append(code)
    rest = pages.filter(~F.coalesce(F.col(language).isin(*routes), F.lit(False)))
    out = extract(rest, default, **options)
    for name, codes in engines.items():
        out = out.unionByName(extract(pages.filter(F.col(language).isin(*codes)), name, **options))
    return out
