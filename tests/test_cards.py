"""Card extraction from plain and broken HTML."""

from helpers import NOON
from lotmill.operators.cards import CARD, CHALLENGE_TEXT, CardReader, extract_listings

LINK = (
    '<div class="slick-slide slick-active slick-current">'
    '<a class="x depth-listing-card-link" href="{}">pic</a></div>'
)


def card(body: str) -> str:
    return f'<li class="a {CARD[1]} b">{body}</li>'


def read(html: str, url: str = "https://www.site.com.my/list?page=1") -> list[dict]:
    return CardReader().read(url, html)


def test_fields_and_entities():
    body = (
        LINK.format("/property/kl/sale-1/?a=1&amp;b=2")
        + '<div class=heading-name><b>Agent</b> &amp;&nbsp; Co</div>'
        + "<h2 class='PremiumCardstyle__TitleWrapper-x'>  The \n  House </h2>"
        + "<ul><li class=\"ListingPricestyle__ItemWrapper\">RM 450,000</li></ul>"
    )
    (found,) = read(f"<ul>{card(body)}</ul>")
    assert found["link"] == "https://www.site.com.my/property/kl/sale-1/?a=1&b=2"
    assert found["agent"] == "Agent & Co"
    assert found["name"] == "The House"
    assert found["price"] == "RM 450,000"
    assert "location" not in found


def test_first_in_document_order_wins():
    a = '<div class="heading-name">Plain</div>'
    b = '<div class="ListingHeadingstyle__HeadingTitle">Title</div>'
    assert read(card(a + b))[0]["agent"] == "Plain"
    assert read(card(b + a))[0]["agent"] == "Title"


def test_child_and_descendant_steps():
    hidden = (
        '<div class="slick-slide slick-active slick-current"><p>'
        '<a class="depth-listing-card-link" href="http://a.b.c/1">x</a></p></div>'
    )
    assert "link" not in read(card(hidden))[0]
    deep = (
        '<div class="BasicCardstyle__DescriptionWrapper-dPdKmp fRMZJr"><section><span>'
        '<h2 class="BasicCardstyle__TitleWrapper-eNIiIX dLdNwJ">Deep</h2></span></section></div>'
    )
    assert read(card(deep))[0]["name"] == "Deep"


def test_fields_outside_cards_do_not_count():
    title = '<h2 class="PremiumCardstyle__TitleWrapper">Out</h2>'
    found = read(title + card("<p>empty</p>") + title)
    assert found == [{}]


def test_unclosed_cards_end_at_the_next():
    one = f'<li class="{CARD[1]}"><h2 class="PremiumCardstyle__TitleWrapper">One</h2>'
    two = f'<li class="{CARD[1]}"><h2 class="PremiumCardstyle__TitleWrapper">Two'
    assert [c["name"] for c in read(f"<ul>{one}{two}")] == ["One", "Two"]


def test_nested_cards_both_count():
    inner = card('<h2 class="PremiumCardstyle__TitleWrapper">In</h2>')
    found = read(card(f"<ul>{inner}</ul>"))
    assert [c.get("name") for c in found] == ["In", "In"]


def test_scripts_comments_and_broken_markup():
    body = (
        "<script>var s = '</li><h2 class=\"PremiumCardstyle__TitleWrapper\">No</h2>';</script>"
        '<!-- <h2 class="PremiumCardstyle__TitleWrapper">No</h2> -->'
        "<![CDATA[ x ]]><br/><img src=a.png>"
        '<h2 title="a > b" class="PremiumCardstyle__TitleWrapper">A < B<br>C<script>x</script></h2>'
        '</span></nope><a href="http://[bad">x</a>'
    )
    (found,) = read(card(body))
    assert found["name"] == "A < B\nC"
    assert read("<a " * 2000 + "b=c " * 2000) == []
    assert read("<!-- " + "<li " * 2000) == []


def test_paragraphs_end_before_blocks():
    attrs = "ListingAttributesstyle__ListingAttrsDescriptionItemWrapper"
    (found,) = read(card(f'<p class="{attrs}">House | Corner<div>other</div>'))
    assert found["attrs"] == "House | Corner"


def test_bad_cards_are_set_apart(spark):
    good = card(LINK.format("https://www.site.com/property/kl/sale-1"))
    no_host = card(LINK.format("mailto:x"))
    short = card('<div class="ListingPricestyle__PricePSFWrapper">(rm)</div>')
    page = f"<ul>{good}{no_host}{short}</ul>"
    rows = [
        (1, "https://u/1", page),
        (2, "https://u/1", page),
        (3, "https://u/2", good + "Checking your browser"),
        (4, "https://u/3", "<p>nothing</p>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = extract_listings(pages, NOON, spread=3).orderBy("card_no").collect()
    assert [(r.page_id, r.card_no, r.reject_reason) for r in got] == [
        (1, 0, None),
        (1, 1, "source"),
        (1, 2, "price_square_feet"),
    ]
    assert got[0].Source == "site" and got[0].Created_At == "2024-01-31 12:00:00"


def test_real_pages_hold_no_cards(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert extract_listings(pages, NOON).isEmpty()


def test_other_selectors_on_real_pages(spark, sf_dir):
    """Every list item of every page as a card, against a plain count."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    fields = {"link": [[("//", "a", "")]], "text": [[("//", "a", "")]]}
    from lotmill.operators.cards import card_texts

    got = card_texts(pages, ("li", ""), fields).groupBy("page_id").count().collect()
    expected = {r.page_id: r.html.count("<li>") for r in pages.collect() if "<li>" in r.html}
    assert {r.page_id: r["count"] for r in got} == expected


def test_a_challenge_hides_no_later_visit(spark):
    card = f'<li class="{CARD[1]}"><div class="heading-name">A</div></li>'
    pages = [
        (1, "https://www.x.com/a", CHALLENGE_TEXT + card),
        (2, "https://www.x.com/a", card),
        (3, None, card),
        (4, "https://www.x.com/b", card),
        (5, "https://www.x.com/a", card),
        (6, None, card),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert sorted(r.page_id for r in extract_listings(df, NOON).collect()) == [2, 3, 4, 6]


def test_a_tag_is_worked_out_once_and_means_the_same_on_later_pages():
    reader = CardReader()
    page = "<script>'<li>'</SCRIPT ><ul>" + card('<div class="heading-name">A\n <b>B</b><br>C</div>') + card(LINK.format("https://x.com/a#b")) + "</ul>"
    first, kinds = reader.read("https://x.com/s", page), dict(reader.kinds)
    assert first == [{"agent": "A B\nC"}, {"link": "https://x.com/a#b"}]
    assert reader.read("https://x.com/s", page) == first and reader.kinds == kinds
    # Every text of a tag is held at most once, whatever stands between; long and many ones are not held for good.
    reader.read("", "".join(f"<p id={i}>" for i in range(12_000)) + f"<p id='{'x' * 600}'>")
    assert len(reader.kinds) <= 10_000 and max(map(len, reader.kinds)) <= 500
