"""Quotes of XML captures: the first of a number counts, and whatever cannot be read gives none."""

from pyspark.sql import functions as F

from matchlake.sources import feeds

NOW = "1998-01-01 00:00:00"


def quote(number, id_, win="2.10", at="1998-01-01 08:00:00", row=True):
    price = f'<row updatetime="{at}" win="{win}" draw="3.00" lost="4"/>' if row else ""
    return f'<m matchnum="{number}" id="{id_}" home="A" away="B" league="L">{price}</m>'


def index(number, id_, day="1998-01-01", clock="20:30"):
    return f"""<TR data-id='{id_}' data-processname="{number}" class=x data-matchdate="{day}" data-matchtime="{clock}"><td></td></TR>"""


def test_quotes_and_documents_that_cannot_be_read(spark):
    xml = "<xml>" + "".join([
        quote("1", "a"), quote("1", "a", "9"), quote("2", "b", "high"), quote("3", "c", row=False), quote("4", "d"), quote("5", "e"), quote("6", "f"), quote("7", ""), quote("", "g"),
        quote("8", "h", "100"), quote("9", "i", "1.00"), quote("10", "j", at="1998-01-01 08:06:00"), quote("11", "k", at="1998-01-01 08:05:00"), quote("12", "l"), quote("13", "m"),
    ]) + "</xml>"
    html = "<table><tr><td data-id='z'></td></tr>" + "".join([
        *(index(n, i) for n, i in (("1", "a"), ("2", "b"), ("3", "c"), ("4", "other"), ("5", "e"), ("5", "e"), ("7", ""), ("8", "h"), ("9", "i"), ("10", "j"), ("11", "k"))),
        index("12", "l", "1998-01-03", "08:00"), index("13", "m", "1998-01-03", "08:01"),
    ])
    rows = [(1, xml, html), (2, None, html), (3, "<xml><m matchnum='1'", html), (4, xml, None), (5, "", ""), (None, "<xml></xml>", html)]
    captures = spark.createDataFrame(rows, "capture_id long, xml string, html string")
    now = F.lit(NOW).cast("timestamp")
    got = feeds.quotes_from_xml(captures, now).withColumns({c: F.col(c).cast("string") for c in ("kickoff", "updated_at")})
    assert sorted((r["capture_id"], r["number"], r["home"]) for r in got.collect()) == [(1, "1", 2.1), (1, "11", 2.1), (1, "12", 2.1), (1, "8", 100.0)]
    one = got.where("number = '1'").first()
    assert (one["source_id"], one["home_name"], one["away_name"], one["league"], one["draw"], one["away"]) == ("a", "A", "B", "L", 3.0, 4.0)
    assert one["kickoff"] == "1998-01-01 12:30:00" and one["updated_at"] == "1998-01-01 00:00:00"
    assert feeds.quotes_from_xml(captures.limit(0), now).collect() == []
