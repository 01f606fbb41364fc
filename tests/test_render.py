"""Spacing, quotes, capitals and the closing period."""

from pairmill.functions.render import render

ROWS = [
    ("hello , world !", "Hello, world!"),
    ("i think i can help . it is ok", "I think I can help. It is ok."),
    ("call 24 / 7 now", "Call 24/7 now."),
    ("this / that", "This/that."),
    ("( a ) / b", "(a) /b."),
    ('he said " hi there " twice', 'He said "hi there" twice.'),
    ("it ' s 's 'll", "It 's's'll."),
    ("a ' quoted ' b", "A 'quoted' b."),
    ("cost $ 5 # 7 [ x ]", "Cost $5 #7 [x]."),
    ("<ph_order_number> for <ph_client_last_name> is <ph_details>",
     "{{Order No}} for {{Client Last Name}} is {{Details}}."),
    ("<url> <email> <user> <unk> <num>",
     "{{Website URL}} {{Customer Support Email}} there {{Number}}."),
    ("<ph_a1b_2c>", "{{A1B 2C}}."),
    ("done .", "Done."),
    ("<unk>", ""),
    ("wow ! ok ? yes", "Wow! Ok? Yes."),
    ("sam @ home _ x", "Sam@home_x."),
    ("end @", "End @."),
]


def test_render(values):
    got = values(lambda t: render(t, {"<ph_order_number>": "Order No"}),
                 [(r.split(),) for r, _ in ROWS], "t array<string>")
    assert got == [want for _, want in ROWS]
    assert values(lambda t: render(t), [([],)], "t array<string>") == [""]


def test_default_slot_name(values):
    assert values(lambda t: render(t), [(["<ph_order_number>"],)], "t array<string>") == [
        "{{Order Number}}."]
