"""The one byte format of emitted JSON: compact, UTF-8 as is, keys in order, a line feed after each line."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

ENCODING = "utf-8"


def json_line(document: Mapping) -> str:
    return json.dumps(document, ensure_ascii=False, separators=(",", ":")) + "\n"


def json_lines(documents: Iterable[Mapping]) -> str:
    return "".join(map(json_line, documents))
