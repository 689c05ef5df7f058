"""Settings: explicit arguments over configuration files over the environment over defaults."""

from __future__ import annotations

import os
import tomllib
from pathlib import Path
from typing import Any

#: Default settings.
DEFAULTS = {"output_dir": "output", "per_case_subdir": "json", "max_retries": 3, "min_delay": 1.0, "emergency_stop": 10, "year_exhausted": 100, "write_audit": False, "keep_exports": 10}


def settings(*files: str, section: str = "app", prefix: str = "DOCKETLOOM_", **given: Any) -> dict[str, Any]:
    """A private file, given first, outranks those after it. A configured zero or empty text counts."""
    out = dict(DEFAULTS)
    for key, value in DEFAULTS.items():
        text = os.environ.get(prefix + key.upper())
        if text is not None:
            out[key] = text.lower() in ("1", "true", "yes") if isinstance(value, bool) else type(value)(text)
    for name in reversed(files):
        if Path(name).exists():
            out |= tomllib.loads(Path(name).read_text()).get(section, {})
    return out | {k: v for k, v in given.items() if v is not None}
