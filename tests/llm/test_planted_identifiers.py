"""Identifiers that no base rule takes, planted in contexts of such that it does, and the same builds out of context."""

import random

from attriflux.llm import pii

CONTEXTS = {0: ["mail me at", "write to", "contact address"], 1: ["host at", "server address", "logged from"],
            2: ["card no", "paid with card", "visa ending"], 3: ["call me on", "phone:", "reach us at"]}


def corpus(docs: int = 1500):
    """Texts, places of planted identifiers with their kinds, and places of decoys."""
    draws = random.Random(1)
    vocabulary = [f"w{draws.randrange(4000)}" for _ in range(4000)]
    words = lambda n: " ".join(draws.choice(vocabulary) for _ in range(n))

    def card(passes: bool) -> str:
        while True:
            digits = "".join(draws.choice("0123456789") for _ in range(16))
            if pii.luhn(digits) == passes:
                return digits

    address = lambda least: ".".join([str(draws.randrange(least, least + 256)), *(str(draws.randrange(256)) for _ in range(3))])
    hidden_forms = [lambda: f"user{draws.randrange(999)}@localhost", lambda: address(300), lambda: card(False),
                    lambda: f"{draws.randrange(200, 999)}-555-{draws.randrange(1000, 9999)}"]
    base_forms = [lambda: f"user{draws.randrange(9999)}@mail{draws.randrange(9)}.example.com", lambda: address(0), lambda: card(True),
                  lambda: f"+1 ({draws.randrange(200, 999)}) 555-{draws.randrange(1000, 9999)}"]
    rows, planted, decoys = [], {}, set()
    for i in range(docs):
        kind, hidden = i % 4, draws.random() < 0.35
        before = f"{words(20)} {draws.choice(CONTEXTS[kind])} "
        value = (hidden_forms if hidden else base_forms)[kind]()
        text = before + value + " " + words(20)
        if hidden:
            planted[i, len(before), len(before) + len(value)] = kind
        if draws.random() < 0.3:
            decoy, before = (card(False) if draws.random() < 0.5 else address(300)), f"{text} {words(1)} "
            decoys.add((i, len(before), len(before) + len(decoy)))
            text = f"{before}{decoy} {words(5)}"
        rows.append((i, text))
    return rows, planted, decoys


def test_contexts_find_unseen_identifiers(spark):
    rows, planted, decoys = corpus()
    base = {(i, s, e) for i, t in rows for s, _, e in pii.base_spans(t)}
    out = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    added = {(r.doc_id, s.start, s.end): s.kind for r in out for s in r.spans if (r.doc_id, s.start, s.end) not in base}
    right = sum(added.get(place) == kind for place, kind in planted.items())
    assert len(planted) > 450 and len(decoys) > 400
    assert right >= 0.9 * len(planted) and right >= 0.9 * len(added) and not decoys & added.keys()
    assert {(i, s, e) for i, s, e in base} <= {(r.doc_id, s.start, s.end) for r in out for s in r.spans}
