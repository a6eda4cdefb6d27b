"""Slight disguises reach the decoder, and plain text comes out of it as it went in."""

import pytest

from tidemark.llm import toxicity


@pytest.fixture(scope="module")
def restorer(spark):
    rows = [("what an idiot said the other person to that silly clown and the moron",)] * 50
    rows += [("you are an ass and a fool you are a moron",)] * 30
    return toxicity.Restorer(toxicity.fit_letters(spark.createDataFrame(rows, "text string")))


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("iddiot", "idiot"),
        ("mmoron", "moron"),
        ("a$$", "ass"),
        ("a55", "ass"),
        ("mor.on", "moron"),
        ("idio+", "idiot"),
        ("foo|", "fool"),
        ("what a m o r o n", "what a moron"),
        ("y o u i d i o t", "you idiot"),
    ],
)
def test_slight_disguises_are_undone(restorer, text, expected):
    assert restorer([text, f"so {text}"]) == [expected, f"so {expected}"]


def test_plain_text_stays(restorer):
    text = "the 4 committees agree: see all! a silly, well-known person, e.g. a b c d; 10.5 moron! x"
    assert restorer([text]) == [text]
