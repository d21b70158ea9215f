"""Opaque page tokens: the sort key of the last row shown."""

from __future__ import annotations

import base64
import binascii
import datetime as dt
import json


def encode_cursor(ts: dt.datetime | str, log_uuid: str) -> str:
    """URL-safe token for one row. Runs on the driver, for a single row per page."""
    text = ts if isinstance(ts, str) else ts.isoformat()
    return base64.urlsafe_b64encode(json.dumps({"ts": text, "id": log_uuid}).encode()).decode()


def decode_cursor(token: str) -> tuple[dt.datetime, str]:
    """Sort key behind a token, as (UTC wall time, id). Raises ValueError for a bad token."""
    try:
        fields = json.loads(base64.urlsafe_b64decode(token.encode()))
        ts = dt.datetime.fromisoformat(fields["ts"])
        if ts.tzinfo is not None:
            ts = ts.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return ts, str(fields["id"])
    except (binascii.Error, UnicodeDecodeError, json.JSONDecodeError, KeyError, TypeError) as e:
        raise ValueError(f"not a page token: {token!r}") from e
