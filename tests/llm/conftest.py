import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(__file__), os.path.dirname(os.path.dirname(__file__))]


@pytest.fixture(scope="session")
def odd_rows():
    """Null id, null and empty and blank texts, repeated rows, a very long text, signs of many kinds."""
    prose = "The quick brown fox, it's said, jumps over 12 lazy dogsé and 3,000 cafés \U0001f600.\n"
    return [
        (1, prose),
        (1, prose),
        (2, None),
        (3, ""),
        (4, " \t\n\x0b\f\r "),
        (None, "no id here"),
        (5, "x" * 30_000 + " " + "word " * 30_000),
        (6, "<|endoftext|> special <|endoftext|>\r\n\x00\x01 \x85 end"),
        (7, prose * 40),
        (8, "中文 Имя İı Å"),
    ]
