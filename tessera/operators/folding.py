"""Folding of single strings on the driver, with the rules of functions.text.fold."""

from __future__ import annotations

import re
import unicodedata


def fold_text(text: str | None) -> str:
    plain = unicodedata.normalize("NFKD", text or "").encode("ascii", "ignore").decode().lower()
    return re.sub("[^a-z0-9+#]+", " ", plain).strip()
