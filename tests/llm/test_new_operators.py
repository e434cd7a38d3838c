"""Secret scan, conversation repair and spelling variants against brute force and plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from monthwise.llm import conversations, jaccard, secrets, variants

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, row string, base string, word string, n long, form string"


def documents(spark, rows):
    """Rows of (doc_id, text, source), with extra columns whose names clash with results."""
    return spark.createDataFrame([(i, t, "en", s, 1, "x", "y", "z", 2, "f") for i, t, s in rows], DOCUMENTS)


# Secret scan

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
LIVE = "Zx9" + "qWe4Rt6Yu8" * 3
COPIED = "Ab1" + "cD2eF3gH4i" * 3
SECRETS = [
    (1, f"key {LIVE} and 😀 ToKeN= 'abcdefgh' token=short", "a"), (1, f"key {LIVE}", "a"), (2, f"see {COPIED}", "a"), (3, f"see {COPIED}", "b"),
    (4, None, "a"), (5, "", None), (6, "AKIA" + "Q" * 12 + " AKIA" + "Q" * 11, None), (None, "f" * 32 + "g" + "e" * 31, "c"),
    (7, "token=ab secret:password=longvalue1 api_key:'" + "0" * 40 + "'", "b"), (8, "é " + "passwd : x1234567 " * 700, "c"), (9, "words " * 40000 + "secret=\"12345678", "d"),
    (10, "ſecret=12345678 toKen=12345678", "d"), (11, "token=secret:longvalue1", "d"),
]


def plain_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32])


def joined(spans):
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(spark, rows):
    frame = documents(spark, rows)
    return secrets.digested(secrets.scanned(frame, frame["source"], frame["source"]))


def test_secret_spans_against_plain_python(spark):
    got = sorted((r.doc_id or 0, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in scan(spark, SECRETS).collect())
    want = []
    for i, text, _ in SECRETS:
        base = plain_spans(text)
        want.append((i or 0, *(sum(k == kind for _, k, _ in base) for kind in range(3)), hashlib.sha256(joined(base).encode()).hexdigest()))
    assert got == sorted(want)


def test_secret_ownership_separates_copies(spark):
    rows = scan(spark, SECRETS).collect()
    held = [r for r in rows if r.doc_id == 1]
    assert all(f"owned:4:{4 + len(LIVE)}" in r.spans for r in held) and len(held) == 2
    assert all(r.spans == "" and r.n_copied == 1 and r.most_owners == 2 for r in rows if r.doc_id in (2, 3))
    assert next(r for r in rows if r.doc_id == 8).n_assign == 700
    assert scan(spark, []).count() == 0


def test_secret_scan_has_no_python_worker(spark):
    plan = scan(spark, SECRETS)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|MapInArrow", plan)


# Conversation repair

TURNS = "conv_id long, turn long, role string, text string, cost string, audit string"


def plain_damage(rows):
    shown = lambda v: " " if v is None else str(v)
    out = []
    for conv, turn, role, text in rows:
        hit = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows, faults):
    """All states after each row by a full table of (cost, audit), without bounds."""
    allowed = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    role_of = {"u": "user", "a": "assistant"}
    now = {"": (0, "", ())}
    for (_, _, role, text), fault in [*zip(rows, faults, strict=True), ((0, 0, "", ""), "end")]:
        for _ in range(4):
            for state, (cost, audit, texts) in list(now.items()):
                for c in "ua":
                    if (state, c) in allowed:
                        new = (cost + 2, audit + "I", (*texts, role_of[c] + ":"))
                        if c not in now or new[:2] < now[c][:2]:
                            now[c] = new
        if fault == "end":
            break
        then = {}
        for state, (cost, audit, texts) in now.items():
            options = [(state, (cost + 3, audit + "D", texts))]
            extra = 1 if fault == "truncated" else 0
            if fault not in ("blank", "duplicate"):
                options += [(c, (cost + 2 + extra, audit + "R", (*texts, f"{role_of[c]}:{text}"))) for c in "ua" if (state, c) in allowed]
                if (state, role[:1]) in allowed:
                    options.append((allowed[state, role[:1]], (cost + extra, audit + "K", (*texts, f"{role}:{text}"))))
            for s, o in options:
                if s not in then or o[:2] < then[s][:2]:
                    then[s] = o
        now = then
    return min((now[s] for s in ("", "a") if s in now), key=lambda x: x[:2])


def plain_conversations(rows):
    out = []
    left = plain_damage(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        faults = plain_faults(mine)
        cost, audit, texts = plain_repair(mine, faults)
        turns = {r[1] for r in mine} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        count = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(texts).encode()).hexdigest()))
    return sorted(out, key=repr)


def random_conversations(seed):
    r = random.Random(seed)
    rows = []
    for conv in [*range(120), None]:
        for turn in range(r.choice([1, 2, 5, 9, 14])):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "Über"])
            rows.append((conv, r.choice([turn, turn, turn, turn + 3, None]), role, r.choice(["a.", "b!", "c", " \x0b\n", "", None, "d? \r", f"t{turn}."])))
    for turn in range(400):
        rows.append((1000, turn, r.choice(["user", "assistant", "system"]), r.choice([f"x{turn}.", f"y{turn}", "again."])))
    rows.append((1001, 0, "user", "very long " * 50000 + "."))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_against_full_table(spark, seed):
    rows = random_conversations(seed)
    frame = spark.createDataFrame([(*r, "c", "d") for r in rows], TURNS)
    got = sorted((tuple(r) for r in conversations.repaired(conversations.damaged(frame)).collect()), key=repr)
    assert got == plain_conversations(rows)


def test_repair_against_all_edit_sequences():
    r = random.Random(3)
    for _ in range(150):
        rows = [(r.choice("suax"), r.choice([None, None, "truncated", "blank"])) for _ in range(r.randint(0, 4))]
        best = min(all_repairs(rows, 0, "", 0, ""))
        found = min(b[0] for b in conversations.search_block(rows, {conversations.START: (0, "")}, True).values())
        assert found == best, rows


def all_repairs(rows, at, roles, cost, audit):
    """Every edit sequence with at most two insertions in a row, judged at its end by the pattern of roles."""
    if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
        yield cost, audit
    if not audit.endswith("II"):
        for c in "ua":
            if re.match("s?(ua)*u?$", roles + c):
                yield from all_repairs(rows, at, roles + c, cost + 2, audit + "I")
    if at < len(rows):
        initial, fault = rows[at]
        yield from all_repairs(rows, at + 1, roles, cost + 3, audit + "D")
        if fault != "blank":
            extra = 1 if fault else 0
            for letter, c, price in [("K", initial, 0), ("R", "u", 2), ("R", "a", 2)]:
                if re.match("s?(ua)*u?$", roles + c):
                    yield from all_repairs(rows, at + 1, roles + c, cost + price + extra, audit + letter)


def test_repair_of_nothing(spark):
    assert conversations.repaired(conversations.damaged(spark.createDataFrame([], TURNS))).count() == 0


# Spelling variants


def plain_vocabulary(rows):
    counts = {}
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if x == y or len(y) - len(x) > 1:
        return False
    k = next((k for k, (a, b) in enumerate(zip(x, y, strict=False)) if a != b), len(x))
    return x[k + (len(x) == len(y)) :] == y[k + 1 :]


def plain_variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(out)


def variant_rows(seed):
    r = random.Random(seed)
    stems = ["".join(r.choice("abcé") for _ in range(r.randint(6, 9))) for _ in range(12)] + ["a" * 6, "a" * 7, "a" * 300, "a" * 301]
    words = {}
    for stem in stems:
        words[stem] = 150
        for _ in range(14):
            k, c = r.randrange(len(stem)), r.choice("abcéÀ")
            words[r.choice([stem[:k] + c + stem[k + 1 :], stem[:k] + stem[k + 1 :], stem[:k] + c + stem[k:]])] = r.choice([5, 6, 29, 30])
    tokens = [w for w, n in words.items() for _ in range(n)]
    r.shuffle(tokens)
    rows = [(k, " ".join(tokens[k::40]).replace("b", "B") + " 12-", "s") for k in range(40)]
    return [*rows, (None, " ".join(tokens[:50]), "s"), (3, None, "s"), (4, "", "s"), rows[0], rows[0]]


@pytest.mark.parametrize("most_words", [variants.MOST_WORDS, 3])
def test_variants_against_all_pairs(spark, most_words):
    rows = variant_rows(5)
    got = sorted(tuple(r) for r in variants.grouped(documents(spark, rows), most_words=most_words).collect())
    want = plain_variants(plain_vocabulary(rows))
    assert len(want) > 50 and any(x[1] for x in want) and got == want


def test_variants_of_nothing(spark):
    assert variants.grouped(documents(spark, [])).count() == 0


def test_acceptor_is_minimal():
    words = sorted({a + b for a in ("x", "y", "zz") for b in ("", "ing", "ed", "s")})
    acceptor = variants.Acceptor(words)
    merged = variants.Acceptor(["", "ed", "ing", "s"])
    assert len(acceptor.edges) == len(merged.edges) + 2


# One document of each group of near copies


def test_distinct_documents_judges_texts_not_ids(spark):
    base = " ".join(f"w{k}" for k in range(60))
    other = " ".join(f"v{k}" for k in range(60))
    third = " ".join(f"z{k}" for k in range(60))
    rows = [
        (1, base, "a"), (2, base + " more", "a"), (2, "a clean text under the same id as a copy", "a"), (None, base + " again", "a"),
        (None, other, "b"), (None, other, "b"), (None, other + " more", "b"), (None, "one more clean text without an id", "b"),
        (7, third, "c"), (7, third, "c"), (7, third + " more", "c"), (8, None, "c"), (8, "", "c"), (None, None, "c"),
    ]
    got = [(r.doc_id, r.text) for r in jaccard.distinct_documents(documents(spark, rows)).collect()]
    of = lambda start: [g for g in got if (g[1] or "").startswith(start)]
    assert of("w0") == [(1, base)]
    assert len(of("v0")) == 1 and of("v0")[0][0] is None and len(of("z0")) == 1 and of("z0")[0][0] == 7
    assert len(of("a clean")) == len(of("one more")) == 1
    assert {g for g in got if not g[1]} == {(8, None), (8, ""), (None, None)}
    assert len(got) == 8
