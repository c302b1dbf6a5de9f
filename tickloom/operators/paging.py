"""Keyset pages and their tokens."""

from __future__ import annotations

import base64
import hashlib
import hmac
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import errors

TTL_SECONDS = 30 * 60


def page(rows: DataFrame, keys: list[str], after: tuple | None, limit: int) -> DataFrame:
    """The newest rows below a key, newest first: a filter that reaches the scan, and a top-k."""
    if not 1 <= limit <= 1000:
        raise errors.InputLimit("a page has 1 to 1000 rows")
    if after is not None:
        below = F.lit(False)
        for i in range(len(keys)):
            same = F.lit(True)
            for j in range(i):
                same = same & (F.col(keys[j]) == F.lit(after[j]))
            below = below | (same & (F.col(keys[i]) < F.lit(after[i])))
        rows = rows.where((F.col(keys[0]) <= F.lit(after[0])) & below)
    return rows.orderBy(*[F.col(k).desc() for k in keys]).limit(limit)


def require_at_most(rows: DataFrame, limit: int) -> DataFrame:
    """rows, unless there are more than limit: then it fails, it does not truncate."""
    if rows.limit(limit + 1).count() > limit:
        raise errors.InputLimit(f"more than {limit} rows")
    return rows


def make_token(secret: bytes, request: dict, plan: str, position: list, principal: str, as_of: int, now: int) -> str:
    """A signed continuation: bound to the request, the plan, the clock and who asked."""
    body = {"request": _digest(request), "plan": plan, "position": position, "principal": principal, "as_of": as_of, "expires": now + TTL_SECONDS}
    raw = json.dumps(body, sort_keys=True, separators=(",", ":")).encode()
    return base64.urlsafe_b64encode(raw).decode() + "." + hmac.new(secret, raw, hashlib.sha256).hexdigest()


def read_token(secret: bytes, token: str, request: dict, plan: str, principal: str, now: int) -> dict:
    """The token's body; fails if it is forged, expired (now == expires is) or made for something else."""
    head, _, signature = token.partition(".")
    try:
        raw = base64.urlsafe_b64decode(head.encode())
    except ValueError as e:
        raise errors.Contract("cursor") from e
    if not hmac.compare_digest(signature, hmac.new(secret, raw, hashlib.sha256).hexdigest()):
        raise errors.Contract("cursor signature")
    body = json.loads(raw)
    if now >= body["expires"]:
        raise errors.Contract("cursor expired")
    if (body["request"], body["plan"], body["principal"]) != (_digest(request), plan, principal):
        raise errors.Contract("cursor of another request")
    return body


def _digest(request: dict) -> str:
    return hashlib.sha256(json.dumps(request, sort_keys=True).encode()).hexdigest()


def date_pages(first: int, last: int, width: int = 3650) -> list[tuple[int, int]]:
    """Half-open pages of days, newest first."""
    out, end = [], last
    while end > first:
        out.append((max(first, end - width), end))
        end -= width
    return out
