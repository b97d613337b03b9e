"""Text inside of drawings and formulas."""

from __future__ import annotations

import pytest
from tidemark.llm.html_text import visible_text


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a<svg><title>t</title><desc>d</desc><defs/><text>one</text><text x='1'>two <tspan>three</tspan></text></svg></p>b", "a\none\ntwo three\n\nb"),
        ("<svg><defs><text>no</text></defs><metadata>m</metadata><style>s{}</style><text>yes</text></svg>", "yes"),
        ("let <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation>x=1</annotation></semantics></math> be", "let x=1 be"),
        ("<svg><g display='none'/><foreignObject><p>in</p></foreignObject></svg><p>out", "in\n\nout"),
        ("<svg style='display:none'><text>no</text></svg>a<svg><text>b</svg>c", "a\nb\nc"),
        ("<svg><path d='M0'><p>after</p>", "after"),
        ("<svg><title/><text>kept</text></svg>", "kept"),
        ("<svg><desc><p>no</p></desc><text>yes</text></svg>", "yes"),
    ],
)
def test_drawings_and_formulas(html, text):
    assert visible_text(html) == text
