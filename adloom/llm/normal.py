"""Form-free text: what is left when case, width, whitespace and punctuation are set aside."""

from __future__ import annotations

import re
import unicodedata

_NOT_ALNUM = re.compile(r"[\W_]+")


def bare(text: str | None) -> str:
    """Letters and digits only, NFKC, case folded. NULL gives ''."""
    if not text:
        return ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return _NOT_ALNUM.sub("", text.casefold())
