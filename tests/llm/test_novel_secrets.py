"""Keys that begin late in the reach of a sensitive word, and long keys of small alphabets."""

import random

from kalendria.llm import secrets


def spans(text):
    return [s[:3] for s in secrets.spans_of(text, secrets.Novelty())]


def test_a_key_may_begin_anywhere_within_reach():
    key = "Zk3vQ9xW2mT7pL5rB8nY4cD6"
    for gap in range(1, secrets.REACH + 8):
        text = "bearer" + "." * gap + key + " end"
        assert spans(text) == ([(6 + gap, 6 + gap + len(key), "novel")] if gap < secrets.REACH else []), gap


def test_long_random_keys_of_small_alphabets():
    r = random.Random(5)
    for letters in ("0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"):
        for n in (16, 64, 96, 128, 512, 2048):
            key = "".join(r.choice(letters) for _ in range(n - 2)) + "A2"
            assert spans(f"the private_key {key} here") == [(16, 16 + n, "novel")], (letters, n)
    assert spans("the private_key " + "get_client_secret_config_value1" * 8 + " here") == []


def test_keys_of_letters_or_digits_alone():
    r = random.Random(6)
    key = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    for letters, n in ((mixed, 24), (mixed, 40), ("0123456789", 20)):
        assert sum(bool(spans(f"the credential is {key(letters, n)} here")) for _ in range(100)) >= 90
    for name in ("internationalization", "http-equiv-content-type-header", "access_token_instance", "getClientSecretConfigValue", "HTTPAuthorizationHeaderName", "=" * 30, "1234567890123456789"):
        assert spans(f"the credential is {name} here") == [], name
