"""Words of UTF-8 texts as bytes: maximal runs of ASCII letters and digits and of all other characters; only A-Z are lower-cased."""

from __future__ import annotations

from collections.abc import Iterator

#: What each byte becomes: A-Z lower-cased, ASCII that is no letter or digit a space.
WORD_BYTES = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def word_slices(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of text in order, in lists from about size bytes each, so a long text is never held as one list."""
    flat, low = text.translate(WORD_BYTES), 0
    while low < len(flat):
        high = flat.find(b" ", low + size)
        high = len(flat) if high < 0 else high
        if found := flat[low:high].split():
            yield found
        low = high
