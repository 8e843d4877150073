"""A small labelled table for the field of personal data: sentences made by rule.

Each row is a stretch of words with a tag per word. Personal data stands in the forms that
patterns know and in those that people write around them (at signs and dots in brackets, blanks
between parts, phones without a plus, dotted cards), and beside it the numbers that look alike
and mean nothing: dates, versions, prices, checksums, long counters.
"""

from __future__ import annotations

import random

# Words that announce a kind.
CUES = {
    "email": ("mail", "email", "e-mail:", "write", "contact", "from"),
    "ip": ("ip", "address", "host", "server", "from", "peer:"),
    "card": ("card", "visa", "card:", "paid", "account"),
    "phone": ("call", "phone", "tel", "tel:", "mobile", "fax"),
    "secret": ("token", "key", "api_key", "secret", "password", "auth"),
    "": ("number", "page", "on", "in", "version", "commit", "digest", "order", "about", "total", "id"),
}
ENDS = ("org", "com", "net", "example", "de", "co.uk")
AT = ("(at)", "[at]", "{at}", "(AT)", "[AT]")
DOT = ("(dot)", "[dot]", "{dot}", "(DOT)", "[.]", "(.)")


def name(rng: random.Random, least: int = 2, most: int = 4) -> str:
    """A word of random syllables: no real one is learned."""
    return "".join(rng.choice("bdfghklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(least, most)))


def digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def card(rng: random.Random, good: bool = True) -> str:
    """Sixteen digits that pass the check by Luhn, or do not."""
    head = rng.choice("3456") + digits(rng, 14)
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(head)))
    last = -total % 10
    return head + str(last if good else (last + rng.randint(1, 9)) % 10)


def fours(number: str, between: str) -> str:
    return between.join(number[i:i + 4] for i in range(0, len(number), 4))


def email(rng: random.Random) -> str:
    local = name(rng) + rng.choice(["", "." + name(rng), str(rng.randrange(99)), "_" + name(rng)])
    host, end = name(rng), rng.choice(ENDS)
    at, dot = rng.choice(AT), rng.choice(DOT)
    return rng.choice([
        f"{local}@{host}.{end}", f"{local} {at} {host}.{end}", f"{local}{at}{host}.{end}",
        f"{local} {at} {host} {dot} {end}", f"{local}{at}{host}{dot}{end}", f"{local} @ {host}.{end}",
        f"{local}@{host} {dot} {end}", f"{local}@{host}{dot}{end}",
    ])


def ip(rng: random.Random) -> str:
    parts = [str(rng.randrange(256)) for _ in range(4)]
    groups = [f"{rng.randrange(1 << 16):x}" for _ in range(8)]
    return rng.choice([
        ".".join(parts), "[.]".join(parts), ".".join(parts[:3]) + "[.]" + parts[3], " . ".join(parts),
        "(.)".join(parts), ":".join(groups), ":".join(groups[:rng.randint(1, 4)]) + "::" + groups[7],
    ])


def payment_card(rng: random.Random) -> str:
    number = card(rng)
    return rng.choice([number, *(fours(number, b) for b in (" ", "-", ".", ".", "/", "_", "  "))])


def phone(rng: random.Random) -> str:
    a, b, c = rng.choice("23456789") + digits(rng, 2), digits(rng, 3), digits(rng, 4)
    return rng.choice([
        f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"({a}){b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}",
        f"1-{a}-{b}-{c}", f"00{rng.randint(30, 49)} {rng.randint(20, 99)} {c} {digits(rng, 4)}",
        f"0{rng.randint(20, 99)}/{digits(rng, 7)}",
    ])


def secret(rng: random.Random) -> str:
    body = "".join(rng.choices("0123456789abcdef", k=rng.choice([32, 40, 64])))
    mixed = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=rng.randint(20, 44)))
    value = rng.choice([body, mixed])
    return rng.choice([f'= "{value}"', f": {value}", f"= {value}", f"= '{value}'", f'"{value}"', value])


def harmless(rng: random.Random) -> str:
    """Numbers and signs that are no personal data."""
    d, m, y = rng.randint(1, 28), rng.randint(1, 12), rng.randint(1900, 2030)
    value = "".join(rng.choices("0123456789abcdef", k=rng.choice([7, 32, 40, 64])))
    return rng.choice([
        f"{y}-{m:02}-{d:02}", f"{d}/{m}/{y}", f"{d}.{m}.{y}", f"{m:02}:{d:02}:{rng.randint(10, 59)}", str(y),
        f"{y}-{y + rng.randint(1, 9)}", f"v{m}.{d}.{rng.randrange(30)}", f"{m}.{d}", f"{m}.{d}.{rng.randrange(30)}",
        f"${rng.randrange(1, 99)},{digits(rng, 3)}.00", f"{rng.randrange(100)}%", digits(rng, rng.randint(1, 12)),
        card(rng, good=False), fours(card(rng, good=False), " "), f"{digits(rng, 3)} {digits(rng, 3)} {digits(rng, 3)}",
        f"978-{rng.randint(0, 9)}-{digits(rng, 2)}-{digits(rng, 6)}-{rng.randint(0, 9)}", f"{digits(rng, 5)}-{digits(rng, 4)}",
        f"{name(rng)[0].upper()}-{digits(rng, 4)}-{digits(rng, 3)}", value, f"sha256:{value}", f"{name(rng)}{digits(rng, 2)}",
        f"@{name(rng)}", f"{d} @ ${m}", f"{d} + {m}", f"{d}x{m}", f"{m}:{d}", f"{m}e-{d}", f"{name(rng, 1, 1)}+{name(rng, 1, 1)}",
        f"https://{name(rng)}.example/{name(rng)}/{d}", f"{name(rng)} (at) the {name(rng)}", f"{m}st", f"({d})", f"[{m}]",
    ])


MAKERS = {"email": email, "ip": ip, "card": payment_card, "phone": phone, "secret": secret, "": harmless}


def sentence(number: int, seed: int) -> list[tuple[str, str]]:
    """(piece of text, kind or "") in order, for one number of the table."""
    rng = random.Random(seed * 1_000_003 + number)

    def filler(most: int) -> list[tuple[str, str]]:
        words = [name(rng, 1, 4) + rng.choice(["", "", "", ",", "."]) for _ in range(rng.randint(0, most))]
        return [(w.capitalize() if rng.random() < 0.2 else w, "") for w in words]

    out = filler(4)
    for _ in range(rng.choice([1, 1, 2])):
        kind = rng.choice(["email", "ip", "card", "phone", "secret", "", "", "", ""])
        # a secret is known by what announces it, the others mostly by themselves
        if kind == "secret" or rng.random() < 0.5:
            out.append((rng.choice(CUES[kind]), ""))
        out.append((MAKERS[kind](rng), kind))
        if rng.random() < 0.2:
            out[-1] = (out[-1][0] + rng.choice([".", ",", ";"]), kind)
        out += filler(5)
    return out
