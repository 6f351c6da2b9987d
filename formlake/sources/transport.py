"""Requests to an export service that answers with CSV text.

A transport is any callable that takes the request's parameters and returns a
binary stream of CSV text. It is pickled to the Python workers.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from typing import BinaryIO

Transport = Callable[[Mapping[str, str]], BinaryIO]

# Parameter names and settings of a flat, raw-coded CSV record export.
RECORD_REQUEST = {
    "content": "record",
    "format": "csv",
    "type": "flat",
    "rawOrLabel": "raw",
    "rawOrLabelHeaders": "raw",
    "exportCheckboxLabel": "false",
}
DICTIONARY_REQUEST = {"content": "metadata", "format": "csv"}
AUDIT_REQUEST = {"content": "log", "format": "csv"}
STAMP = "%Y-%m-%d %H:%M:%S"


@dataclass(frozen=True)
class ExportOptions:
    """What the source is asked to include in record exports."""

    survey_fields: bool = False
    access_groups: bool = False
    blank_for_gray_status: bool = False
    filter_logic: str = ""
    modified_after: datetime | None = None
    modified_before: datetime | None = None
    fields: tuple[str, ...] = ()
    forms: tuple[str, ...] = ()
    events: tuple[str, ...] = ()
    extra: Mapping[str, str] = field(default_factory=dict)

    def record_params(self, scoped: bool = True) -> dict[str, str]:
        """Parameters of a record request; ``scoped`` adds fields, forms and events."""

        def flag(on: bool) -> str:
            return "true" if on else "false"

        def stamp(at: datetime | None) -> str:
            return at.strftime(STAMP) if at else ""

        params = {
            **RECORD_REQUEST,
            "exportSurveyFields": flag(self.survey_fields),
            "exportDataAccessGroups": flag(self.access_groups),
            "filterLogic": self.filter_logic,
            "dateRangeBegin": stamp(self.modified_after),
            "dateRangeEnd": stamp(self.modified_before),
            "exportBlankForGrayFormStatus": flag(self.blank_for_gray_status),
            **self.extra,
        }
        if scoped:
            for name in ("fields", "forms", "events"):
                if getattr(self, name):
                    params[name] = ",".join(getattr(self, name))
        return params


class FormPost:
    """Form POST over HTTP with retries on gateway timeouts and lost connections.

    The token travels only in the request body and is kept out of ``repr`` and errors.
    """

    def __init__(
        self, url: str, token: str, max_retries: int = 10, timeout: float = 600.0
    ) -> None:
        self._url, self._token = url, token
        self._max_retries, self._timeout = max_retries, timeout

    def __repr__(self) -> str:
        return f"FormPost({self._url!r})"

    def __call__(self, params: Mapping[str, str]) -> BinaryIO:
        body = urllib.parse.urlencode({"token": self._token, **params}).encode()
        for attempt in range(self._max_retries + 1):
            try:
                request = urllib.request.Request(self._url, data=body, method="POST")
                return urllib.request.urlopen(request, timeout=self._timeout)
            except urllib.error.HTTPError as e:
                if e.code != 504 or attempt == self._max_retries:
                    raise
            except urllib.error.URLError:
                if attempt == self._max_retries:
                    raise
            time.sleep(min(2.0**attempt, 60.0))
        raise AssertionError("unreachable")
