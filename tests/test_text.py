"""Name comparison and config extraction."""

import pytest

from guardwork.fixed import CONFIG_MARKER
from guardwork.functions import ci, config_name

M = CONFIG_MARKER


@pytest.mark.parametrize(
    ("command", "expected"),
    [
        (f"EXECUTE x {M}Sales'\t", "Sales"),
        (f"EXECUTE x {M.upper()}Sales'", "Sales"),
        (f"EXECUTE x {M}'", ""),
        (f"EXECUTE x {M}two\nlines'", "two\nlines"),
        (f"EXECUTE x {M}first' {M}second'", "first"),
        (f"EXECUTE x {M}no end", None),
        ("EXECUTE x", None),
        (None, None),
    ],
)
def test_config_name(spark, command, expected):
    df = spark.createDataFrame([(command,)], "command string")
    assert df.select(config_name("command")).first()[0] == expected


def test_names_ignore_case_and_trailing_blanks_but_not_accents(spark):
    df = spark.createDataFrame([("Été  ", " été", "ete")], "a string, b string, c string")
    row = df.select(ci("a") == "été", ci("b") == "été", ci("c") == "été").first()
    assert tuple(row) == (True, False, False)
