"""The small corpus the tests of the training-data operators share."""

import random

CLASHING = ("id", "g", "h1", "shard", "x", "score", "kept", "spans", "seg", "key", "n", "label", "_row", "band", "v")
WORDS = "the of and a in to is was he for it with as his on be at by".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))


def corpus(seed=3):
    """(doc_id, text, lang, source) rows: plain, empty, null, long, repeated, near copies, shared passages, secrets."""
    rng = random.Random(seed)
    passage = sentence(rng, 80)
    base = sentence(rng, 120)
    rows = [(i, sentence(rng, rng.randrange(1, 90)), rng.choice(["en", "de", None]), "a") for i in range(40)]
    rows += [(100 + i, f"{sentence(rng, 12)} {passage} {sentence(rng, 9)}", "en", "b") for i in range(6)]
    rows += [(200 + i, base.replace(base.split()[i * 9], "changed", 1), "de", "b") for i in range(6)]
    rows += [(300 + i, base, "fr", "c") for i in range(3)]
    rows += [(400, None, "en", "a"), (401, "", None, None), (402, " \t\n ", "en", "a"), (403, "é𝄞" * 150, "en", "a"),
             (404, "a" * 900, "en", "a"), (405, "x y " * 200, "en", "a"), (406, sentence(rng, 9000), "en", "long"),
             (407, "é" * 99 + "z" + "é" * 99 + "q" + "é" * 99 + "z" + "é" * 99, "en", "a"),
             (408, 'password = "abcd12345" AKIA' + "A" * 14 + " " + "0f" * 20, "en", "s"),
             (409, "user_id=bob password=abcd https://host.example/x", "en", "s"),
             (410, "password=abcd alone", "en", "s"), (411, "token=secret:abcdefgh12 secret==abcdefgh", "en", "s"),
             (412, "one\ntwo\none\n\n one\ntwo", "en", "a")]
    rows += [(7, rows[7][1], rows[7][2], "a"), (None, base, "en", "a"), (None, "no id, " + sentence(rng, 30), None, None),
             (None, "no id, either", None, None), (None, "no id, either", None, None)]
    return rows
