"""Short parts of an article on pages without ``article`` and ``main``."""

import pytest

from firegrid.llm import html_text

LONG = "<p>" + "Words of a long paragraph go on. " * 6 + "</p>"
LINKS = "<div class='x'>" + "".join(f"<span><a href=x>{i}</a></span>" for i in range(12)) + "</div>"
PARTS = {
    "list": "<ul>" + "".join(f"<li>Item number {i} is here</li>" for i in range(10)) + "</ul>",
    "quote": "<blockquote>To be.</blockquote><blockquote><p>Not to be.</p></blockquote>",
    "table": "<table>" + "".join(f"<tr><td>a{i}</td><td>b{i}</td></tr>" for i in range(6)) + "</table>",
    "section": "<section><h2>Head</h2><div><ol><li>One</li><li>Two</li><li>Three</li></ol></div></section>",
}


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("at", ["middle", "end"])
def test_short_parts_stay(part, at):
    after = LONG * 6 if at == "middle" else ""
    got = html_text.main_text(f"<body>{LINKS}<div>{LONG * 6}{PARTS[part]}{after}</div>{LINKS}</body>").split("\n")
    want = [x.text for x in html_text.parsed(PARTS[part]).lines]
    assert got[6:6 + len(want)] == want
    assert sum(x.startswith("Words of") for x in got) == (12 if at == "middle" else 6) and not got[0].startswith("0")


def test_one_container_per_paragraph():
    long = "<div class='par'>" + "Words of a long paragraph go on. " * 6 + "</div>"
    short = "".join(f"<div class='par'>Short {i}.</div>" for i in range(6))
    got = html_text.main_text(f"<body>{LINKS}<div id='w'>{short}{long * 3}{short}{long * 3}{short}</div>{LINKS}</body>").split("\n")
    assert len(got) == 24 and [x for x in got if x.startswith("Short")] == [f"Short {i}." for i in range(6)] * 3


def test_dropped_parts_go_and_parts_beside_stay_out():
    got = html_text.main_text(f"<body>{LINKS}<div>{LONG * 4}<div class='ad'>Buy</div><ul><li>x</li></ul>{LONG * 4}</div>{LINKS}</body>").split("\n")
    assert sum(x.startswith("Words of") for x in got) == 8 and "x" in got and "Buy" not in got and not got[0].startswith("0")
