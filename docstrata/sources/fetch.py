"""Fetching of pages and assets in tasks: retries with backoff, spacing, a size cap in bytes, decoding; a failure stays with its row.

The connection is the caller's: a function from an address to a Reply, made once in each task. Nothing here needs a network.
"""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)


@dataclass(frozen=True)
class Reply:
    status: int
    body: bytes = b""
    headers: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Policy:
    """How often, how long and how much. spacing is the least time in seconds between two requests of a task, retries included."""

    attempts: int = 3
    delay: float = 2.0
    longest: float = 30.0
    spacing: float = 0.0
    most_bytes: int = 10 << 20
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    jitter: Callable[[], float] = lambda: random.uniform(0.5, 1.5)


def decoded(body: bytes, content_type: str | None) -> str:
    """UTF-8 without a byte order mark, else the declared charset, else UTF-8 with signs for what is none."""
    try:
        return body.decode("utf-8-sig")
    except UnicodeDecodeError:
        declared = _CHARSET.search(content_type or "")
        try:
            return body.decode(declared[1] if declared else "utf-8", "strict" if declared else "replace")
        except (LookupError, UnicodeDecodeError):
            return body.decode("utf-8", "replace")


def _wait(reply: Reply | None, attempt: int, p: Policy) -> float:
    """Seconds before the next attempt: a numeric Retry-After within 0 and the longest wait, else doubling with jitter."""
    said = next((v for k, v in reply.headers.items() if k.lower() == "retry-after"), None) if reply else None
    try:
        return max(0.0, min(p.longest, float(said)))
    except (TypeError, ValueError):
        return min(p.longest, p.delay * 2 ** (attempt - 1)) * p.jitter()


class Fetcher:
    """Requests of one task. Failures other than 429 among 400 to 499 are final, as is a body over the cap; others are tried again."""

    def __init__(self, get: Callable[[str], Reply], policy: Policy) -> None:
        self.get, self.policy, self.next = get, policy, None

    def _spaced(self) -> None:
        p, now = self.policy, self.policy.clock()
        if self.next is not None and self.next > now:
            p.sleep(self.next - now)
            now = max(now, self.next)
        self.next = now + p.spacing

    def fetch(self, url: str) -> tuple[bytes | None, str | None, str | None, int]:
        """(body, content type, error, attempts)."""
        p, error = self.policy, None
        for attempt in range(1, p.attempts + 1):
            self._spaced()
            reply = None
            try:
                reply = self.get(url)
            except Exception as e:
                error = f"{type(e).__name__}: {e}"[:500]
            else:
                if 200 <= reply.status < 300:
                    if len(reply.body) > p.most_bytes:
                        return None, None, "body over the size limit", attempt
                    kind = next((v for k, v in reply.headers.items() if k.lower() == "content-type"), None)
                    return reply.body, kind, None, attempt
                error = f"HTTP {reply.status}"
                if 400 <= reply.status < 500 and reply.status != 429:
                    return None, None, error, attempt
            if attempt < p.attempts:
                p.sleep(_wait(reply, attempt, p))
        return None, None, error, p.attempts


def fetched(addresses: DataFrame, url: str, connect: Callable[[], Callable[[str], Reply]], policy: Policy = Policy()) -> DataFrame:
    """Adds (body, text, error, attempts) to rows with an address. A null address is an error of its row; so is every failure.

    Rows are spread by the caller: as many requests run at once as there are tasks.
    """
    kept = [c for c in addresses.columns if c not in ("body", "text", "error", "attempts")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetcher = Fetcher(connect(), policy)
        for rows in batches:
            done = [fetcher.fetch(u) if isinstance(u, str) else (None, None, "no address", 0) for u in rows[url]]
            yield rows.assign(body=[b for b, *_ in done], text=[None if b is None else decoded(b, k) for b, k, *_ in done], error=[e for *_, e, _ in done], attempts=[n for *_, n in done])

    rows = addresses.select(*kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", body binary, text string, error string, attempts int"
    return rows.mapInPandas(run, schema)
