"""Formulas and drawings in pages."""

import pytest
from textloom.llm.html_text import visible_text


@pytest.mark.parametrize(
    "page,want",
    [
        ('<p>before <svg class="icon"/> after</p>', "before after"),
        ("<p>a <math/> b</p><p>c</p>", "a b\n\nc"),
        ("<p>if <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then</p>", "if x=2 then"),
        ("<math><semantics><mi>x</mi><annotation encoding='tex'>\\hat x</annotation></semantics></math>", "x"),
        ("<svg><title>t</title><desc>d</desc><defs><text>no</text></defs><metadata>m</metadata><text x='1'>North</text><text>South</text></svg> end", "North South end"),
        ("<svg><title/><style/><path d='M0'/><g><text>kept</text></g></svg> end", "kept end"),
        ("<svg><a href=/x/>link</a></svg> end", "link end"),
        ("<svg><foreignObject><div/>inside</foreignObject></svg>", "inside"),
        ("<head><title>hidden</title></head><div/>still", "still"),
        ('<svg style="display:none"><text>sprite</text></svg>seen', "seen"),
    ],
)
def test_foreign(page, want):
    assert visible_text(page) == want
