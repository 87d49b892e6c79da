"""The log of a run: a file of the driver's, shown on the screen as well if asked for."""

from __future__ import annotations

import logging
import os
import sys
from datetime import datetime


def logger(folder: str, name: str, echo: bool = False) -> logging.Logger:
    """A log in {folder}/{name}_{time}.log; a second call closes the former file of that name."""
    os.makedirs(folder, exist_ok=True)
    out = logging.getLogger(f"quadmill.{name}")
    for old in list(out.handlers):
        out.removeHandler(old)
        old.close()
    targets: list[logging.Handler] = [logging.FileHandler(os.path.join(folder, f"{name}_{datetime.now():%Y%m%dT%H%M%S.%f}.log"))]
    if echo:
        targets.append(logging.StreamHandler(sys.stdout))
    for t in targets:
        t.setFormatter(logging.Formatter("[{asctime}] {levelname}: {message}", "%Y-%b-%d %H:%M:%S", "{"))
        out.addHandler(t)
    out.setLevel(logging.INFO)
    out.propagate = False
    return out
