import hashlib
import re

from helixframe.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x if k % 2 == 0 else x * 2 - 9 * (x > 4) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (
                kind == "ip" and any(int(x) > 255 for x in m[0].split("."))
                or kind == "card" and not (14 <= len(d) <= 19 and luhn(d))
                or kind == "phone" and not 10 <= len(d) <= 15
            ):
                continue
            out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


TRICKY = [
    "a@b.c_d@e.f x@y a@b..c a.b@c-d.e-f.", "1.2.3.4.5.6 999.1.1.1 0255.1.1.1 00000000000000000000001.2.3.4 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 79927398713000",
    "+1 (555) 123-4567 ++49 30 1234567. +1 2", "😀 mail é@x.de ümail me@x.de, card 4111111111111111 +4111111111111111", "call +1 555 123 45678 or 10.0.0.1:80",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, not DE88370400440532013000", "1" * 5000 + "@a.b" + "." * 5000, "a@b.c " * 900, "+1" * 3000, "1.1" * 4000,
    "٣.٣.٣.٣ １２３", None, "",
]


def test_base_spans_are_those_of_the_plain_patterns(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TRICKY)], "doc_id long, text string, score string")
    rows = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    for i, t in enumerate(TRICKY):
        got = [f"{s.kind}:{s.start}:{s.end}" for s in rows[i].spans if s.rank < len(pii.BASE)]
        assert got == base(t), t
        assert all(0 <= s.score <= 1 for s in rows[i].spans)


def test_checksums_and_context(spark):
    docs = spark.createDataFrame([(0, TRICKY[6]), (1, "visa card 4111111111111111"), (2, "4111111111111111")], "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in pii.find_personal_data(docs).collect()}
    assert [TRICKY[6][s.start : s.end] for s in rows[0] if s.kind == "iban"] == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
    assert rows[1][0].score > rows[2][0].score


def test_query_digests(spark, sf, sf_docs):
    rows = {r.doc_id: r for r in pii.op5_pii(spark, sf).collect()}
    for i, t in sf_docs:
        want = base(t)
        assert rows[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert rows[i].n_email == sum(x.startswith("email") for x in want)


def test_edge_rows(edge_docs, no_docs):
    assert pii.find_personal_data(edge_docs).count() == edge_docs.count()
    assert pii.find_personal_data(no_docs).count() == 0


def test_context_on_both_sides_whatever_else_matches_there(spark):
    card = "4111111111111111"
    texts = [
        f"{card} (visa)", f"visa {card}, {card}", f"{card} and {card} visa", card, f"{card} " + "x" * 60 + " visa", "visa " + "x" * 60 + f" {card}",
        *("😀é\n" * n + f"visa {card}" for n in (80, 84, 85, 170)), *("é😀" * n + f" {card} visa" for n in (110, 119, 120, 127, 128)),
        "call 10.0.0.1 10.0.0.2 server", "a@b.cd c@d.ef " * 400 + "mail",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find_personal_data(docs).collect():
        t = texts[r.doc_id]
        assert r.spans
        for s in r.spans:
            n = pii.CONTEXT_CHARS
            word = re.compile(pii.CONTEXT[s.kind])
            near = word.search(t[max(0, s.start - n) : s.start]) or word.search(t[s.end : s.end + n])
            assert abs(s.score - min(1.0, pii.SCORES[s.kind] + (pii.CONTEXT_BONUS if near else 0))) < 1e-9, (t[:80], s)
