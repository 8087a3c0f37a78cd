"""Conversation repair against plain versions: all edits of short signatures, and whole tables by simple code."""

import itertools
import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from rillmart.llm import conversation_repair as repair
from rillmart.llm.queries import REGISTRY

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
GRAMMAR = re.compile(r"(s?(ua)+)?")
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def plain_damage(rows):
    space = lambda x: " " if x is None else x
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind == 0:
            yield conv, turn, role, text, False
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        for _ in range(2 if kind == 3 else 1):
            yield conv, turn, role, text, True


def plain_best(rows):
    """Least (cost, audit, lines) of rows (initial, fault, role, text); from the end, one suffix at a time."""
    names = {"u": "user", "a": "assistant"}
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}  # the role to insert after what stands last

    def with_inserts(best):
        out = dict(best)
        for _ in range(2):
            for g, t in follow.items():
                c, audit, lines = out[t]
                out[g] = min(out[g], (c + 2, "I" + audit, [f"{names[t]}:", *lines]))
        return out

    far = (10**9, "", [])
    best = with_inserts({"": (0, "", []), "s": far, "u": far, "a": (0, "", [])})
    for initial, fault, role, text in reversed(rows):
        now = {}
        for g, t in follow.items():
            c, audit, lines = best[g]
            options = [(c + 3, "D" + audit, lines)]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                c, audit, lines = best[t]
                options.append((c + 2 + extra, "R" + audit, [f"{names[t]}:{text}", *lines]))
                if initial == t or (g == "" and initial == "s"):
                    c, audit, lines = best[initial]
                    options.append((c + extra, "K" + audit, [f"{role}:{text}", *lines]))
            now[g] = min(options, key=lambda o: o[:2])
        best = with_inserts(now)
    return best[""]


def plain_reports(rows):
    """By conversation, from rows (conv, turn, role, text, present) with nulls in role and text replaced."""
    by_conv = defaultdict(list)
    for conv, turn, role, text, present in rows:
        by_conv[conv] += [(turn, role, text)] if present else []
    out = {}
    for conv, said in by_conv.items():
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha256(r[2].encode()).digest()))
        seen, marked = set(), []
        for _, role, text in said:
            shown = VISIBLE.findall(text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role[:1], fault, role, text))
        turns = [t for t, _, _ in said if t is not None]
        gaps = min(max(turns) - min(turns) + 1 - len(set(turns)), 2**63 - 1) if turns else 0
        cost, audit, lines = plain_best(marked) if marked else (0, "", [])
        faults = [f for _, f, _, _ in marked]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest())
    return out


def every_audit(letters):
    """All (cost, audit) of a few rows by trying every edit, with at most two inserted rows in each place."""
    names = {"u": "u", "a": "a"}
    for inserts in itertools.product(*[["", "u", "a", "ua", "au"]] * (len(letters) + 1)):
        for edits in itertools.product("KuaD", repeat=len(letters)):
            cost, audit, result = 0, "", ""
            for place, letter in enumerate([*letters, None]):
                cost, audit, result = cost + 2 * len(inserts[place]), audit + "I" * len(inserts[place]), result + inserts[place]
                if letter is None:
                    continue
                edit = edits[place]
                if edit != "D" and letter == "x":
                    break
                cost += 3 if edit == "D" else letter.isupper() + 2 * (edit in names)
                audit += "R" if edit in names else edit
                result += "" if edit == "D" else letter.lower() if edit == "K" else edit
            else:
                if GRAMMAR.fullmatch(result):
                    yield cost, audit


def test_a_node_has_the_least_of_all_edits():
    rng = random.Random(5)
    for letters in ["", *["".join(rng.choice("suaoSUAOx") for _ in range(n)) for n in (1, 1, 1, 2, 2, 2, 2, 3, 3)]]:
        value = repair.NOTHING_LEFT
        for letter in reversed(letters):
            value = repair.node_value(letter, value)
        start = [(v[0] + end[0], v[1] + end[1]) for v, end in zip(value[repair.START], repair.END, strict=True) if v]
        assert min(start) == min(every_audit(letters)), letters


def table(spark, rows):
    named = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    return named.withColumns({"conv": F.lit(3), "kind": F.lit("k"), "signature": F.lit("s"), "present": F.lit(False), "k": F.lit(0)})


def odd_rows():
    rng = random.Random(8)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "supervisor", "agent"]
    texts = ["Hello there.", "No end", "  \t\n\x0b\x0c\r ", "", None, "What?!", "é…", "Ünder. ", "x", "Hello there. \n", " ", "!"]
    rows = [(i % 40, rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for i in range(600)]
    rows += [(None, t, rng.choice(roles), rng.choice(texts)) for t in range(300)]  # no id, and longer than a block
    rows += [(500, t, rng.choice(roles[:3]), f"part {rng.randrange(200)}.") for t in range(700)]
    rows += [(501, 4, "user", "again and again")] * 150  # copies
    rows += [(502, None, "user", "no turn."), (503, -(2**62), "user", "a."), (503, 2**62 + 5, "assistant", "b."), (504, 1, "user", "long " * 40_000)]
    rows += [(c, 0, "user", "Only.") for c in range(600, 760)]  # some are dropped whole
    return rows


def test_odd_conversations(spark):
    rows = odd_rows()
    hurt = repair.damage(table(spark, rows))
    assert hurt.columns == ["conv_id", "turn", "role", "text", "present"]
    got = repair.repair_reports(hurt, present=F.col("present")).collect()
    want = plain_reports(plain_damage(rows))
    assert len(got) == len(want)
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == want
    assert any(w[-2] == "" and w[0] == 0 for w in want.values()) and any(len(w[-2]) > 3 * repair.BLOCK for w in want.values())


def test_repaired_rows_are_legal_and_hash_alike(spark):
    rows = odd_rows()
    df = table(spark, rows)
    want = plain_reports((c, t, " " if r is None else r, " " if x is None else x, True) for c, t, r, x in rows)
    by_conv = defaultdict(list)
    for r in repair.repaired_rows(df).collect():
        by_conv[r.conv_id].append(r)
    for conv, (*_, digest) in want.items():
        said = sorted(by_conv[conv], key=lambda r: r.place)
        assert [r.place for r in said] == list(range(1, len(said) + 1))
        assert GRAMMAR.fullmatch("".join(r.role[0] for r in said))
        assert sha256("\n".join(f"{r.role}:{r.text}" for r in said).encode()).hexdigest() == digest
        assert all((r.turn is None and r.text == "") for r in said if r.edit == "I")


def test_nothing_and_other_types(spark):
    empty = spark.createDataFrame([], "conv_id STRING, turn INT, role STRING, text STRING")
    assert repair.repair_reports(repair.damage(empty), present=F.col("present")).count() == 0
    assert repair.repaired_rows(empty).count() == 0
    named = spark.createDataFrame([("x", 1, "user", "Hi."), ("x", 2, "assistant", "Hi."), ("y", None, None, None)], empty.schema)
    got = {r.conv_id: (r.cost, r.audit) for r in repair.repair_reports(named).collect()}
    assert got == {"x": (0, "KK"), "y": (3, "D")}
    absent = repair.repair_reports(named, present=F.lit(None).cast("boolean")).collect()
    assert {(r.conv_id, r.cost, r.audit, r.repaired_sha256) for r in absent} == {(c, 0, "", sha256(b"").hexdigest()) for c in "xy"}


def test_a_node_is_worked_out_once(monkeypatch):
    import pandas as pd

    made, plain = [], repair.node_value
    monkeypatch.setattr(repair, "node_value", lambda letter, rest: made.append(letter) or plain(letter, rest))
    words = sorted({"ua", "xua", "suua", "uua", "u", "a", "suaua", "auaua"}, key=lambda w: w[::-1])
    list(repair._solve(iter([pd.DataFrame({"signature": words[:3]}), pd.DataFrame({"signature": words[3:]})])))
    assert len(made) == len({w[i:] for w in words for i in range(len(w))})


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_13(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in REGISTRY["op13_conversation_repair"](spark, folder).collect()}
    assert got == plain_reports(plain_damage(rows))
