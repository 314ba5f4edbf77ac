"""Main text: what the cut decides, what is learned, and pages that are hard to parse."""

import dataclasses
import time

import pytest

from clickloom.llm import html_extract
from clickloom.llm.html_extract import Weights

LONG = ("The harbour was rebuilt after the storm, and the boats came back one by one in the spring "
        "of the following year, as the older people of the town had said they would.")
BODY = (f"<h1>The harbour</h1><p>{LONG}</p><p>So it went.</p><p><a href=/map>Map</a> of the whole bay</p>"
        f"<p>{LONG}</p><p>And then</p><p>{LONG}</p>")
TEXT = f"The harbour {LONG} So it went. Map of the whole bay {LONG} And then {LONG}"
NAV = "<nav><ul><li><a href=/>Home</a></li><li><a href=/b>Boats</a></li></ul></nav>"
AD = "<div class=ad>Cheap sails here.</div>"
FOOT = "<footer>All rights reserved.</footer>"
TAUGHT = [f"<body>{NAV}{AD}<article><h1>The harbour</h1><p>{LONG}</p><p>So it went.</p></article>"
          f"{FOOT}</body>" for _ in range(3)]
PAGES = [f"<body>{NAV}{AD}<article>{BODY}</article>{FOOT}</body>" for _ in range(3)]


@pytest.fixture(scope="module")
def learned(spark):
    table = spark.createDataFrame([(p,) for p in [*TAUGHT, None, "", "<p>No tags that tell."]],
                                  "html string")
    return Weights.learn(table)


def without_edges(w):
    return dataclasses.replace(w, follows=0.0, same_parent=0.0)


def test_the_cut_decides_with_and_without_an_article(learned):
    plain = BODY.replace("<p>", "<div>").replace("</p>", "</div>")
    other = (f"<body>{NAV}{AD}<div>{plain}</div><div><a href=/x>More boats</a></div>{FOOT}</body>")
    for w in (learned, Weights()):
        assert html_extract.main_text(PAGES[0], w) == TEXT
        assert html_extract.main_text(other, w) == TEXT
        # A linked paragraph and a short one are content only for what is around them.
        assert html_extract.main_text(other, without_edges(w)) != TEXT
    told = f"<body>{NAV}{AD}<article>{plain}</article>{FOOT}</body>"
    weak = dataclasses.replace(learned, in_main=0.0)
    assert html_extract.main_text(told, weak) == TEXT
    assert html_extract.main_text(told, without_edges(weak)) != TEXT


def test_learning(spark, learned):
    assert learned == Weights.learn(spark.createDataFrame([(p,) for p in TAUGHT], "html string"))
    # Nothing that tells: the weights are the given ones.
    assert Weights.learn(spark.createDataFrame([], "html string")) == Weights()
    assert Weights.learn(spark.createDataFrame([("<p>a",)], "html string")) == Weights()
    assert learned.same_parent > learned.follows >= 0


@pytest.mark.parametrize("page", [
    f"{NAV}<form action=/><article>{BODY}</article></form>{FOOT}",
    f"{NAV}<form action=/><div>{BODY}</div></form>{FOOT}",
    f"{NAV}<article class='story share'>{BODY}</article>{FOOT}",
    f"{NAV}<div class='story share'>{BODY}</div>{FOOT}",
    f"{NAV}<div class='page-header content'>{BODY}</div>{FOOT}",
    f"{NAV}<div><article>{BODY}</article><form>Your name <p>{LONG}</p></form></div>{FOOT}",
    f"{NAV}<article>{BODY}<div class=comments><article class=comment><p>{LONG}</p></article>"
    f"<p>{LONG}</p></div></article>{FOOT}",
    f"{NAV}<article>{BODY}<div class='advert'><p>{LONG}</p><p>{LONG}</p></div></article>",
    f"{NAV}<div id=cookie-notice><p>{LONG}</p></div><main>{BODY}</main><aside><p>{LONG}</p></aside>",
    f"{NAV}<main><a title='a > b'></a>{BODY}<script>x = '<p>y</p>'</script></main>",
])
def test_containers(learned, page):
    assert html_extract.main_text(page, learned) == TEXT
    assert html_extract.main_text(page) == TEXT


@pytest.mark.parametrize("piece", [
    "<a '", '<a b="', "<b>x", "<a b=\">\" ", "<head>x", "<form>x ", "</i><b>", "<", "<!", "<div><p>ab. ",
    "<p><a href=x>ab</a></p><div>cd ef gh ij kl.</div>"])
def test_time_grows_with_the_page(piece):
    def seconds(n):
        began = time.process_time()
        html_extract.main_text(piece * (n // len(piece)))
        return time.process_time() - began

    assert seconds(400_000) < 12 * max(0.05, seconds(100_000))


def test_odd_markup():
    held = [b.text for b in html_extract.blocks("<p>1 < 2 <p title=\"x>y\">b <i title='q'>c</i> <d")]
    assert held == ["1 < 2", "b c <d"]
    assert [b.text for b in html_extract.blocks("<p>a <!-- <p> --> b<!doctype x>c")] == ["a bc"]
    # A quote without an end: the tag ends at the next bracket.
    assert [b.text for b in html_extract.blocks("<p title=\"x>one<p>two")] == ["one", "two"]
    assert html_extract.main_text("<script>" + "x" * 10) == ""


def test_max_flow_is_the_smallest_cut_on_long_chains():
    n = 3000
    score = [0.5 if k % 7 else -1.0 for k in range(n)]
    joined = [(k - 1, k, 1.2) for k in range(1, n)]
    assert all(html_extract.minimum_cut(score, joined))
