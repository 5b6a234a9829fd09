import hashlib
import random
import re

from strata.llm import secrets
from tests.llm.data import clashing, edge_rows, frame, prose

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def base(text):
    """The fixed forms by the letter of their definition."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found)]


def rows():
    texts = [
        'é token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" ß 字', "password: token: abcdef", "password=a token=abcdefg",
        "PassWord:'hunter22' api_key=xyz apikey = 'abc.def-ghi'", "ſecret=abcdefgh toKen=abcdefgh", "AKIA" + "A1" * 8,
        "AKIAAKIA" + "B" * 11, "xAKIA" + "9" * 15 + " AKIA" + "9" * 16, "0" * 23 + "g" + "f" * 24, "token=token=abcdef",
        'secret":"' + "f" * 30, "token\n= abcdefgh", "token   :   'abcdefgh", "no secrets here", "api__key=abcdefgh",
        "🙂 password=🙂abcdefgh password=abcdefgh🙂", "token=" + "a" * 5 + " " + "token=" + "a" * 6,
    ]
    return [(1000 + i, t, "en", "s", len(t)) for i, t in enumerate(texts)]


def test_fixed_forms_as_brute_force(spark):
    data = edge_rows() + rows()
    found = secrets.digest(secrets.scanned(clashing(frame(spark, data)), [b"name", b"value"])).collect()
    want = sorted((str(r[0]), hashlib.sha256(",".join(base(r[1])).encode()).hexdigest()) for r in data)
    assert sorted((str(r.doc_id), r.base_sha256) for r in found) == want
    for r in found:
        spans = [s for s in r.spans.split(",") if s]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex")]


def documents_with_keys():
    """Prose with a key in sensitive context, beside names, paths and copies of known strings."""
    rng = random.Random(9)
    data, keys = [], {}
    for i in range(40):
        key = "".join(rng.choice(ALPHABET) for _ in range(rng.choice([20, 32, 48])))
        text = prose(rng, 120)
        if i % 2:
            text += f" the client_key for all is {key} and stays "
            keys[i] = key
        else:
            text += (" the auth module getUserAccessTokenFromStorage_v12 is in the path src/getUserAccessTokenFromStorage_v11/auth "
                     f"of the private key expires 2024-01-01T00:00:00Z and much later, where nothing of that kind is said any more, {key} stands ")
        data.append((i, text + prose(rng, 60), "en", "s", 1))
    return data, keys


def test_novel_strings_in_sensitive_context_are_reported(spark):
    data, keys = documents_with_keys()
    docs = frame(spark, data)
    names = secrets.identifiers(docs)
    found = {r.doc_id: [s.value for s in r.spans if s.kind == "novel"] for r in secrets.scanned(docs, names).collect()}
    for i, text, *_ in data:
        if i in keys:
            assert any(keys[i].strip("+/=") in v or v in keys[i] for v in found[i]), (keys[i], found[i])
        else:
            assert found[i] == [], found[i]


def test_names_and_repeats_are_not_novel():
    names = [b"internationalization", b"authentication", b"configuration"]
    scan = secrets.Novelty(names)
    rng = random.Random(2)
    for n in (16, 24, 40, 64, 200):
        key = "".join(rng.choice(ALPHABET) for _ in range(n))
        text = f"a b c {key} d e f".encode()
        assert secrets.novel(key.encode(), scan.of(text, 6, 6 + n))
        twice = f"{key} a b c {key} d e f".encode()
        assert scan.of(twice, n + 7, 2 * n + 7) < 0.6
    text = b"the authentication_configuration_2 x"
    assert scan.of(text, 4, 34) < secrets.NOVELTY


def test_places_are_code_points_and_spans_do_not_overlap(spark):
    key = "Zk3vQ9xT1LmP7cRb2WnY"
    text = f"字🙂é bearer {key} token = abcdefgh"
    spans = secrets.scanned(frame(spark, [(1, text, "en", "s", 1)]), []).first().spans
    assert [(s.kind, text[s.start:s.end]) for s in spans] == [("novel", key), ("assign", "token = abcdefgh")]


def test_dictionary_counts_the_whole_corpus(spark):
    rows = [(i, "alpha_name beta9 ab gamma " * 3 if i % 2 else "alpha_name", "en", "s", 1) for i in range(10)]
    assert secrets.identifiers(frame(spark, rows)) == [b"alpha_name", b"gamma"]


def test_empty_table(spark):
    none = frame(spark, [])
    assert secrets.identifiers(none) == []
    assert secrets.digest(secrets.scanned(none, [])).collect() == []
