"""The prefix trie and the structure repair against brute force."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from facetrank.llm import convrepair, prefixtrie
from facetrank.llm.queries import rebuilt_turns, repair_digests
from tests.llm.fixtures import tuples

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
CLASHING = f"{SCHEMA}, place bigint, name string, depth int, task int, end string, kind int, n int"


def frame(spark, rows, clashing=False):
    if not clashing:
        return spark.createDataFrame(rows, SCHEMA)
    return spark.createDataFrame([(*r, 1, "n", 2, 3, "e", 4, 5) for r in rows], CLASHING)


def digest(role: str, text: str) -> bytes:
    role, text = role.encode(), text.encode()
    return hashlib.sha256(str(len(role)).encode() + b":" + role + text).digest()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def turn_key(turn):
    return (turn is not None, turn or 0)


# Prefix trie


def brute_trie(sequences: dict[int, list[tuple[str, str]]]):
    members, ends = {}, {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    out = []
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        out.append(
            (
                min(own),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(own),
                len(children),
                len(leaves),
                saved,
                sha(",".join(map(str, sorted(ends.get(node, []))))),
            )
        )
    return sorted(out, key=repr)


def brute_rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append((turn_key(turn), digest(role, text), (role, text)))
    own = {c: [r[2] for r in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(rng, convs, longest, kinds):
    rows = []
    for c in convs:
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(kinds)))
    return rows


def test_trie_of_rebuilt_conversations(spark):
    rng = random.Random(5)
    ids = [*range(40), *range(101, 140), *range(200, 215), 305]
    rows = conversations(rng, ids, 9, ["a", "bb", "é\U0001f600"])
    rows += [(7, None, None, None), (8, 3, "user", "twice"), (8, 3, "user", "twice"), (None, 1, "user", "x"), (41, None, "", "")]
    turns = prefixtrie.named_turns(frame(spark, rows, clashing=True).repartition(5))
    got = prefixtrie.trie(*rebuilt_turns(turns))
    assert tuples(got, *NODE) == brute_trie(brute_rebuilt(rows))


def test_deep_trie_with_one_conversation_of_most_rows(spark):
    """Depths that are no powers of two, a prefix that many share and a hot conversation."""
    rng = random.Random(8)
    base = [("user", f"t{i % 7}") for i in range(75)]
    sequences = {0: base + [("user", "x" * i) for i in range(138)]}
    for c in range(1, 25):
        cut = rng.choice([0, 1, 31, 32, 33, 64, 75])
        sequences[c] = base[:cut] + [("user", rng.choice("pq")) for _ in range(rng.randint(0, 6))]
    rows = [(c, t, *turn) for c, turns in sequences.items() for t, turn in enumerate(turns)]
    turns = prefixtrie.named_turns(frame(spark, rows))
    ids = spark.createDataFrame([(c,) for c in sequences], "conv_id bigint")
    assert tuples(prefixtrie.trie(ids, turns), *NODE) == brute_trie(sequences)


def test_trie_of_nothing(spark):
    turns = prefixtrie.named_turns(frame(spark, []))
    assert prefixtrie.trie(*rebuilt_turns(turns)).count() == 0
    without = spark.createDataFrame([(4,), (5,)], "conv_id bigint")
    assert tuples(prefixtrie.trie(without, turns), *NODE) == [(4, 0, None, 2, 0, 1, 0, sha("4,5"))]


# Structure repair

NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def cheapest(rows):
    """Least cost and then least audit by search over (row, state), one letter at a time.

    ``rows`` are (role, text, fault); returns cost, audit and what remains.
    """
    best = [(0, "", 0, 0, ())]
    seen = set()
    while best:
        cost, audit, i, state, out = heapq.heappop(best)
        if i == len(rows) and state in (0, 3):
            return cost, audit, list(out)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        for role in ("user", "assistant"):
            if role[0] in NEXT[state]:
                heapq.heappush(best, (cost + 2, audit + "I", i, NEXT[state][role[0]], (*out, (role, ""))))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(best, (cost + 3, audit + "D", i + 1, state, out))
        if fault in ("blank", "duplicate"):
            continue
        extra = int(fault == "truncated")
        if role[:1] in NEXT[state]:
            heapq.heappush(best, (cost + extra, audit + "K", i + 1, NEXT[state][role[:1]], (*out, (role, text))))
        for other in ("user", "assistant"):
            if other[0] in NEXT[state]:
                heapq.heappush(
                    best, (cost + 2 + extra, audit + "R", i + 1, NEXT[state][other[0]], (*out, (other, text)))
                )


def brute_repair(rows):
    every, kept = {r[0] for r in rows}, {}
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        for _ in range(2 if kind == 3 else 1):
            kept.setdefault(c, []).append((turn_key(turn), role, digest(role, text), text, turn))
    out = []
    for c in every:
        own, seen = [], set()
        counts = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        damaged = sorted(kept.get(c, []), key=lambda r: r[:3])
        for _, role, _, text, _ in damaged:
            bare = text.strip(" \t\n\x0b\x0c\r")
            if not bare:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            own.append((role, text, fault))
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(own, own[1:], strict=False)]
        turns = {r[4] for r in damaged} - {None}
        cost, audit, rest = cheapest(own)
        out.append(
            (
                c,
                max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                counts["blank"],
                counts["duplicate"],
                counts["truncated"],
                sum(p not in ("su", "ua", "au") for p in pairs),
                cost,
                audit,
                sha("\n".join(f"{r}:{t}" for r, t in rest)),
            )
        )
    return sorted(out, key=repr)


REPAIR = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_the_search_takes_the_least_audit():
    """The brute force itself, on cases that can be told by hand."""
    assert cheapest([]) == (0, "", [])
    assert cheapest([("user", "a.", "")])[:2] == (2, "KI")
    assert cheapest([("system", "a.", "")])[:2] == (3, "D")
    assert cheapest([("user", "a.", ""), ("user", "b.", "")])[:2] == (2, "KR")
    assert cheapest([("assistant", "a.", "")])[:2] == (2, "IK")


@pytest.mark.parametrize("chunk", [1, 2, 3, 4096])
def test_repair_of_random_rows(spark, chunk):
    """All chunk sizes give the result of the whole search."""
    rng = random.Random(chunk)
    roles = ["user", "assistant", "system", "tool", "usher", "", None]
    texts = ["One.", "two", "Three!", " ", "", None, "four? ", "é.\n", "a.b", "\x0b", "x "]
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 14)):
            rows.append((c, rng.choice([t, t, t + 2, None]), rng.choice(roles), rng.choice(texts)))
    rows += [(None, 1, "user", "no id."), (None, None, "assistant", "no id!")]
    rows += [(60, t, rng.choice(["tool", "user"]), f"{t}.") for t in range(90)]
    got = repair_digests(frame(spark, rows, clashing=True).repartition(4), chunk)
    assert tuples(got, *REPAIR) == brute_repair(rows)


def test_whole_conversations_stay_as_they_are(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "user", "U?"), (1, 2, "assistant", "A!"), (2, 1, "user", "u."), (2, 2, "assistant", "a.")]
    repaired, report = convrepair.repair(frame(spark, rows))
    assert tuples(repaired, "conv_id", "role", "text") == sorted([(c, r, x) for c, _, r, x in rows], key=repr)
    assert tuples(report, "conv_id", "cost", "audit") == [(1, 0, "KKK"), (2, 0, "KK")]


def test_repair_of_nothing(spark):
    assert repair_digests(frame(spark, [])).count() == 0
    # All rows of this one are dropped by the damage.
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    got = repair_digests(frame(spark, [(dropped, 1, "user", "x.")]))
    assert tuples(got, *REPAIR) == [(dropped, 0, 0, 0, 0, 0, 0, "", sha(""))]
