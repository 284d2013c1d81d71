"""Credential values of the least length, their separators, and what goes on behind a base assignment."""

import random
import string

import pytest

from lakeops.llm import credentials


def reported(text):
    return [text[s:e] for s, _, kind, e in credentials.secret_spans(text) if kind == "credential"]


@pytest.mark.parametrize(
    "alphabet, share",
    [
        (string.ascii_letters + string.digits, 0.97),
        (string.ascii_letters, 0.94),
        (string.ascii_lowercase + string.digits, 0.85),
        (string.ascii_letters + string.digits + "!#$%&*+-./:=?@^_~", 0.99),
    ],
)
def test_random_values_of_eight_and_nine_characters(alphabet, share):
    pick = random.Random(7)
    for length in (8, 9):
        values = ["".join(pick.choices(alphabet, k=length)) for _ in range(2_000)]
        assert sum(reported(f"pwd={v}") == [v] for v in values) >= share * len(values), length


def test_short_values_in_every_place():
    for text in ("pwd=xK9mQ2vL", "passphrase: xK9mQ2vL", "bearer xK9mQ2vL", "password is xK9mQ2vL"):
        assert reported(text) == ["xK9mQ2vL"], text
    assert reported("password: xK9#mQ2$") == ["xK9#mQ2$"]


def test_common_words_are_no_secrets():
    words = "password sunshine Princess football BASEBALL superman iloveyou changeme required Optional unknown. built-in"
    for value in [*words.split(), "welcome12", "password1", "letmein2020", "12345678", "aaaaaaaaa", "qwertyuio"]:
        assert reported(f"pwd={value}") == [], value
        assert reported(f"the passphrase is {value}") == [], value


def test_aligned_and_tabbed_settings():
    value = "xK9mQ2vLpprT"
    wide = " " * 30
    for text in (
        f"pwd{wide}={wide}{value}", f"passphrase:\t{value}", f"pwd\t=\t\t'{value}'", f"secret{wide}:= \t xK9#mQ2$pprT",
        f"Authorization:\tBearer  {value}", f"bearer\t{value}", f"password \tis\t {value}",
    ):
        assert reported(text) == [text.split()[-1].strip("'")], text
    assert reported("pwd" + " " * 200_000 + "x") == [] and reported("bearer \t" * 50_000) == []


def test_value_that_goes_on_behind_a_base_assignment():
    text = "secret=abcdefgh$9fK2#mmQx"
    assert credentials.secret_spans(text) == [(0, 0, "assign", 15), (7, 3, "credential", len(text))]
    assert reported("secret=xK9mQ2vLpprT") == [] and reported('token: "xK9mQ2vLpprT"') == []
