"""Headers, rules, contacts and body cleaning on small hand-made mails."""

import pytest
from pyspark.sql import functions as F

from threadsift.functions import headers as hdr
from threadsift.functions import rules
from threadsift.functions.text import clean_body
from threadsift.operators import contacts, mails

HEADERS = "array<struct<name:string,value:string>>"


def one(spark, value, kind, column):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first().y


def mail(**values):
    return [(name.replace("_", "-"), value) for name, value in values.items()]


def test_first_header_wins_without_case(spark):
    headers = [("SUBJECT", "one"), ("subject", "two")]
    assert one(spark, headers, HEADERS, lambda h: hdr.header(h, "Subject")) == "one"
    assert one(spark, headers, HEADERS, lambda h: hdr.header(h, "from")) == ""
    assert one(spark, None, HEADERS, lambda h: hdr.header(h, "from")) == ""


@pytest.mark.parametrize(
    "sender, address, name",
    [
        ("Ann <ANN@x.com>", "ann@x.com", "Ann"),
        ('"Ann Lee" <ann@x.com>', "ann@x.com", "Ann Lee"),
        (" ann@x.com\t", "ann@x.com", ""),
        ("<ann@x.com>", "ann@x.com", ""),
        ("", "", ""),
    ],
)
def test_sender_parts(spark, sender, address, name):
    assert one(spark, sender, "string", hdr.address) == address
    assert one(spark, sender, "string", hdr.display_name) == name


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Tue, 02 Jan 2024 10:00:00 +0000", "2024-01-02 10:00:00"),
        ("2 Jan 2024 10:00:00 +0200", "2024-01-02 08:00:00"),
        ("Tue, 2 Jan 2024 10:00:00 GMT", "2024-01-02 10:00:00"),
        ("Tue, 2 Jan 2024 10:00:00 -0500 (EST)", "2024-01-02 15:00:00"),
        ("2024-01-02T10:00:00Z", "2024-01-02 10:00:00"),
        ("soon", None),
        ("", None),
    ],
)
def test_mail_dates(spark, text, expected):
    assert one(spark, text, "string", lambda c: hdr.mail_date(c).cast("string")) == expected


@pytest.mark.parametrize(
    "address, blocked",
    [
        ("", True),
        ("   ", True),
        (None, True),
        ("NoReply@brand.com", True),
        ("no-reply@brand.com", True),
        ("noreplyy@brand.com", False),
        ("meetings-noreply@google.com", True),
        ("ann@news.brand.com", True),
        ("ann@agency.gov", True),
        ("ann@brand.com", False),
        ("help", False),
        ("edm.support@x.co", True),
    ],
)
def test_blocked_senders(spark, address, blocked):
    assert one(spark, address, "string", rules.blocked_sender) is blocked


@pytest.mark.parametrize(
    "headers, reason",
    [
        (mail(From="Ann <ann@brand.com>", Subject="Hi"), None),
        (mail(From="ann@brand.com", Authentication_Results="dkim=fail"), "auth"),
        (mail(From="ann@brand.com", Authentication_Results="dkim=fail dmarc=pass"), None),
        (mail(From="ann@brand.com", Authentication_Results="DKIM=PASS"), "auth"),
        (mail(From="info@brand.com"), "sender"),
        (mail(From="ann@brand.com", List_Id=""), "bulk_header"),
        (mail(From="ann@brand.com", X_Mailer="Sent by MailChimp"), "bulk_header"),
        (mail(From="ann@brand.com", PRECEDENCE="list"), "bulk_header"),
        (mail(From="ann@brand.com", Subject="Big PROMO today"), "subject"),
        (mail(From='"The Team" <x@brand.com>'), "sender_name"),
        (mail(From="promo77@yahoo.net"), "free_mail"),
        (mail(Subject="no sender"), None),
        ([], None),
        (None, None),
    ],
)
def test_reject_reasons(spark, headers, reason):
    assert one(spark, headers, HEADERS, rules.reject_reason) == reason
    frame = spark.createDataFrame([(headers,)], f"headers {HEADERS}")
    assert rules.with_reject_reason(frame).first().reason == reason
    flags = frame.select(*[c.alias(n) for n, c in rules.rule_flags(F.col("headers")).items()]).first().asDict()
    assert (reason is None) == (not any(flags.values()))
    assert reason is None or flags[reason]


def test_custom_rule_lists(spark):
    lists = rules.RuleLists(automated_subject_terms=("hello (world)",))
    frame = spark.createDataFrame([([("Subject", "Hello (World)!")],), ([("Subject", "promo")],)], f"headers {HEADERS}")
    assert [r.reason for r in rules.with_reject_reason(frame, lists).collect()] == ["subject", None]


@pytest.mark.parametrize(
    "body, clean",
    [
        (None, ""),
        ("", ""),
        ("Hi\r\n\r\n\r\n\r\nthere  you\t\tare", "Hi\n\nthere you are"),
        ("a < b and c > d", "a < b and c > d"),
        ("<p>One</p><p>Two &amp; three</p>", "One\n\nTwo & three"),
        ("<html><head><title>T</title></head><body>In<br/>side</body></html>", "In\nside"),
        ("<div>x<script>var a='</b>';</script><style>p{}</style>y</div>", "xy"),
        ("<h1>Head</h1><ul><li>a</li><li>b</li></ul>", "HEAD\n\n * a\n\n * b"),
        ('<a href="http://x.co">here</a> <a href="x.co">x.co</a>', "here [http://x.co] x.co"),
        ("<b>&#8364;5 &#x20AC;6 &amp;lt; &unknown; &</b>", "€5 €6 &lt; &unknown; &"),
        ("New text\n\nOn Mon, Ann wrote:\n> old\n> older", "New text"),
        ("New text\n\nOn Mon, 2 Jan\nAnn <a@b.c> wrote:\n> old", "New text"),
        ("Bye\n--\nAnn Lee\nBrand", "Bye"),
        ("Bye\nSent from my phone", "Bye"),
        ("> only\n> quoted", "> only\n> quoted"),
        ("a\n   \n\t\nb", "a\n\nb"),
    ],
)
def test_clean_body(spark, body, clean):
    assert one(spark, body, "string", clean_body) == clean


@pytest.mark.parametrize(
    "body, clean",
    [
        ("Hello\n--\nAnn\n\nReal paragraph", "Hello\n--\nAnn\n\nReal paragraph"),
        ("Hello\n__\nSection\n\nOne\n\nTwo\n--\nAnn", "Hello\n__\nSection\n\nOne\n\nTwo"),
        ("Hello\nSent from my phone\n\nReal paragraph", "Hello\nSent from my phone\n\nReal paragraph"),
        ("Hello\n--\nAnn\nBrand\n \n\n", "Hello"),
        ("Hello\n\n-- \nAnn\n\nOn Mon, Bo wrote:\n> old\n", "Hello"),
        ("Hello\n--\n" + "line\n" * 20000, "Hello"),
        ("Hello\n--flag\nAnn", "Hello\n--flag\nAnn"),
    ],
)
def test_only_a_signature_that_ends_the_mail_goes(spark, body, clean):
    assert one(spark, body, "string", clean_body) == clean


@pytest.mark.parametrize(
    "body, clean",
    [
        # Quotes of any depth go; what stands around and between them stays.
        ("<div>New</div><blockquote>old <blockquote>older</blockquote> old</blockquote><p>After</p>", "New\n\nAfter"),
        ("<p>A</p><blockquote><p>q1</p><p>q2</p></blockquote><p>B</p><blockquote>q3<br>q4</blockquote>C", "A\n\nB\n\nC"),
        ("<BlockQuote type='cite'>a</BLOCKQUOTE><p>b</p>", "b"),
        ("<blockquote>one<blockquote>two</blockquote></blockquote>", "> one\n>\n> > two"),
        ("x</blockquote>y<p>z</p>", "xy\n\nz"),
        ("<p>a</p><blockquote>never closed<p>b</p>", "a"),
        # Numbers of ordered lists, each list on its own.
        ("<ol><li>a</li><li>b</li></ol>", "1. a\n\n 2. b"),
        ("<p>x</p><ol start='7'><li>a<ol><li>in</li><li>in</li></ol></li><li>b</li></ol>", "x\n\n 7. a\n 1. in\n\n 2. in\n\n 8. b"),
        ("<p>x</p><ul><li>a<ol><li>n</li></ol></li><li>b</li></ul>", "x\n\n * a\n 1. n\n\n * b"),
        ("<p>x</p><ol><li>a<ul><li>n</li></ul><li>b</ol>", "x\n\n 1. a\n * n\n\n 2. b"),
        ("<li>lone</li><ol></ol></ol><b/>", "* lone"),
        # A row is a line, its cells stand one space apart.
        ("<table><tr><th>Item</th><th>Price</th></tr><tr><td>Ad</td><td>&euro;5</td></tr></table>", "Item Price\n\nAd €5"),
        ("<p>t</p><table><tbody><tr> <td>a</td> <td><b>b</b></td> </tr></tbody></table><p>u</p>", "t\n\na b\n\nu"),
        ("<table><tr><td>a</td><td><table><tr><td>i</td><td>j</td></tr></table></td><td>c</td></tr></table>", "a\n\ni j\n\nc"),
        ("<td>cell</td><td>without table</td>", "cellwithout table"),
    ],
)
def test_nested_structure_of_html(spark, body, clean):
    assert one(spark, body, "string", clean_body) == clean


def test_deep_and_long_structure(spark):
    deep = "<p>top</p>" + "<blockquote>q" * 300 + "</blockquote>" * 300 + "<p>end</p>"
    assert one(spark, deep, "string", clean_body) == "top\n\nend"
    long = "<ol>" + "".join(f"<li>{i}</li>" for i in range(500)) + "</ol>"
    lines = one(spark, long, "string", lambda c: clean_body(c, 10**6)).split("\n\n")
    assert [x.strip() for x in lines] == [f"{i + 1}. {i}" for i in range(500)]


@pytest.mark.parametrize(
    "body, clean",
    [
        ("Oui\n\nLe lun. 3 janv. 2024 à 10:00, Ann <a@b.c> a écrit :\n> ancien", "Oui"),
        ("Oui\n\nLe 3 janv. 2024,\nAnn <a@b.c> a écrit\u00a0:\n> ancien", "Oui"),
        ("Ja\n\nAm Mo., 3. Jan. 2024 um 10:00 Uhr schrieb Ann <a@b.c>:\n> alt", "Ja"),
        ("Sí\n\nEl lun, 3 ene 2024 a las 10:00, Ann (<a@b.c>) escribió:\n> viejo", "Sí"),
        # Sentences that only look like attributions stay.
        ("Le patron a écrit :\nbonjour", "Le patron a écrit :\nbonjour"),
        ("Am Ende schrieb er das auf:\nalles", "Am Ende schrieb er das auf:\nalles"),
        # Header blocks go, the text below them stays.
        ("See below\n\nFrom: Ann\nSent: Monday\nTo: Bo\nSubject: Offer\n\nWe offer 5", "See below\n\nWe offer 5"),
        ("Voir\n\nDe : Ann\nEnvoyé : lundi\nÀ : Bo\nObjet : Offre\n\nTexte", "Voir\n\nTexte"),
        ("Siehe\n\nVon: Ann\nGesendet: Montag\nAn: Bo\nBetreff: Angebot\n\nText", "Siehe\n\nText"),
        ("Ver\n\nDe: Ann\nEnviado el: lunes\nPara: Bo\nAsunto: Oferta\n\nTexto", "Ver\n\nTexto"),
        ("Note\nFrom: the shop\nTo: you", "Note\nFrom: the shop\nTo: you"),
        ("Hi\n\n-----Original Message-----\nFrom: Ann\nTo: Bo\nSubject: X\n\nold", "Hi\n\nold"),
        ("FYI\n\n---------- Forwarded message ---------\nFrom: Ann\nDate: Mon\nSubject: X\nTo: Bo\n\noffer", "FYI\n\noffer"),
        # Signatures, from the last fragment upwards.
        ("Hello\n\n--\nAnn\n\nSent from my phone", "Hello"),
        ("Hello\n--\nAnn\n \n__\nLegal text\nmore", "Hello"),
        ("Salut\n\nEnvoyé de mon iPhone", "Salut"),
        ("Hallo\n\nVon meinem iPhone gesendet", "Hallo"),
        ("Hola\n\nEnviado desde mi iPhone", "Hola"),
        ("Hi\nGet Outlook for iOS", "Hi"),
        ("Hi\n\n--\nAnn\n\nP.S. one more thing\n\n--\nAnn", "Hi\n\n--\nAnn\n\nP.S. one more thing"),
        ("--\nonly a signature", "--\nonly a signature"),
        # All of it at once, in HTML.
        ("<p>Yes</p><p>--<br>Ann</p><div>On Mon, Bo wrote:<blockquote>old<blockquote>older</blockquote></blockquote></div>", "Yes"),
    ],
)
def test_reply_fragments(spark, body, clean):
    assert one(spark, body, "string", clean_body) == clean


def test_long_bodies_are_cut_and_marked(spark):
    assert one(spark, "é" * 3001, "string", clean_body) == "é" * 3000 + "\n[... truncated]"
    assert one(spark, "é" * 3000, "string", clean_body) == "é" * 3000


def test_latest_header_sender(spark):
    rows = [
        ("t1", 1, mail(From="Old <old@x.co>", Date="Mon, 01 Jan 2024 10:00:00 +0000")),
        ("t1", 2, mail(From="Me <me@c.com>", Date="Wed, 03 Jan 2024 10:00:00 +0000")),
        ("t1", 3, mail(From="no-reply@x.co", Date="Thu, 04 Jan 2024 10:00:00 +0000")),
        ("t1", 4, mail(From="New <NEW@x.co>", Date="Tue, 02 Jan 2024 10:00:00 +0000")),
        ("t2", 1, mail(From="first@x.co", Date="unknown")),
        ("t2", 2, mail(From="second@x.co")),
        ("t3", 1, mail(From="me@c.com")),
    ]
    frame = spark.createDataFrame(rows, f"thread_id string, position bigint, headers {HEADERS}")
    creators = spark.createDataFrame([("t1", " ME@c.com"), ("t3", "me@c.com")], "thread_id string, creator_email string")
    found = {r.thread_id: (r.email, r.name) for r in contacts.latest_header_sender(frame, creators).collect()}
    assert found == {"t1": ("new@x.co", "New"), "t2": ("first@x.co", None)}


def test_latest_stored_sender_looks_past_any_number_of_unusable_rows(spark):
    count = 700
    meta = spark.range(count).select(
        F.concat(F.lit("m"), "id").alias("id"),
        F.lit("u").alias("user_id"),
        F.lit("t").alias("thread_id"),
        F.timestamp_seconds("id").alias("received_at"),
    )
    senders = spark.range(count).select(
        F.concat(F.lit("m"), "id").alias("email_metadata_id"),
        F.when(F.col("id") == 3, F.lit(" Ann@x.co ")).otherwise("noreply@x.co").alias("sender_email"),
        F.lit(" Ann ").alias("sender_name"),
    )
    settings = spark.createDataFrame([], "user_id string, email string")
    assert [tuple(r) for r in contacts.latest_stored_sender(meta, senders, settings).collect()] == [
        ("t", "u", "ann@x.co", "Ann")
    ]


def test_enrichment_keeps_unmatched_messages(spark):
    messages = spark.createDataFrame([("m1", "own"), ("m2", "own2")], "message_id string, thread_id string")
    rows = spark.createDataFrame([("m1", "e1", "t1", "sum")], "message_id string, email_metadata_id string, thread_id string, previous_ai_summary string")
    got = {r.message_id: (r.id, r.thread_id, r.previous_ai_summary) for r in mails.enrich(messages, rows).collect()}
    assert got == {"m1": ("e1", "t1", "sum"), "m2": (None, "own2", None)}


def test_usable_truth(spark):
    email = "struct<headers:array<struct<name:string,value:string>>,body:string>"
    rows = [
        ("ok", [(mail(From="a@x.co"), ""), (mail(From="info@x.co"), "text")]),
        ("filtered", [(mail(From="info@x.co"), "text")]),
        ("blank", [(mail(From="a@x.co"), " \n"), (mail(From="a@x.co"), None)]),
        ("none", []),
    ]
    truth = spark.createDataFrame(rows, f"id string, emails array<{email}>")
    assert {r.id: r.drop_reason for r in mails.usable_truth(truth).collect()} == {
        "ok": None, "filtered": "static_filter", "blank": "empty_body", "none": "empty_body",
    }
    assert tuple(mails.usable_truth_counts(truth).first()) == (4, 2, 1, 1)
