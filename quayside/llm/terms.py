"""Terms of texts: runs of letters (and digits), every character beyond ASCII among them, with A-Z lower-cased."""

from __future__ import annotations


def separators(digits: bool) -> bytes:
    """For ``bytes.translate``: A-Z become a-z, other ASCII that is no letter (nor digit, where those count) a blank.

    Bytes of 128 and more are parts of other characters, all of which belong to terms.
    """
    def value(b: int) -> int:
        if 65 <= b <= 90:
            return b + 32
        return b if b >= 128 or 97 <= b <= 122 or (digits and 48 <= b <= 57) else 32

    return bytes(value(b) for b in range(256))


def terms_of(text: str | None, table: bytes) -> list[bytes]:
    """The terms of a text as UTF-8, in order; none for a null."""
    return text.encode().translate(table).split() if text else []
