"""Documents with the awkward cases that every operator has to stand."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()


def prose(seed: int, words: int) -> str:
    """Distinct deterministic sentences."""
    out, state = [], seed * 7919 + 13
    for i in range(words):
        state = (state * 1103515245 + 12345) % (1 << 31)
        word = WORDS[state >> 8 & 15] + WORDS[state >> 14 & 15]
        if i % 9 == 0:
            word = word.capitalize()
        out.append(word + (". " if i % 9 == 8 else " "))
    return "".join(out).strip()


def awkward() -> list[tuple]:
    """Null ids and texts, empty and very long texts, repeated rows."""
    long_text = prose(99, 20_000)
    return [
        (1, prose(1, 120), "en", "a", 1),
        (1, prose(1, 120), "en", "a", 1),
        (1, prose(2, 80), None, None, None),
        (2, None, "en", "a", None),
        (3, "", "de", None, 0),
        (4, " \t\n", "de", "a", 3),
        (None, prose(3, 60), "fr", "b", 2),
        (None, None, None, None, None),
        (5, long_text, "en", "b", 5),
        (6, "x" * 50_000, "en", "b", 5),
        (7, "one two", "en", "b", 7),
        (8, "é \U0001f600 ñ a@b.co \U0001f600 4111 1111 1111 1111", "es", "b", 7),
    ]
