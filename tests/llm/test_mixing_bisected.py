"""The exponent of a repetition limit is bisected, and is the root of what the limit says."""

import math

import pytest

from bulwark.llm import mixing


@pytest.mark.parametrize("sizes, repeats", [((900, 60, 4), 2.0), ((7, 3), 2.0), ((7, 3), 2.5), ((10**9, 1), 4.0), ((5, 4, 3), 1.0), ((5, 4, 3), 0.5)])
def test_repetition_limit(spark, monkeypatch, sizes, repeats):
    asked, bisected = [], mixing.bisected
    monkeypatch.setattr(mixing, "bisected", lambda fits: bisected(lambda a: asked.append(a) or fits(a)))
    got = mixing.fit_exponent(spark.createDataFrame([(n,) for n in sizes], "n long"), None, repeats).exponent
    assert asked and got == round(max(0.0, 1 - math.log(max(1.0, repeats)) / math.log(max(sizes) / min(sizes))), 6)
