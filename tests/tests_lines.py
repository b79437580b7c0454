"""Seven parsable lines over four days and two that are not, for file-based tests."""


def _line(day, url, addr="10.0.0.1"):
    return f'{addr} [2024-01-{day:02d}T10:00:00+00:00] "GET {url} HTTP/1.1" 200 10 "a" 0.1 1.0 x "CI=n" true "-" "r" "-"'


_ONE = f"/package/00000000-0000-0000-0000-000000000001/{'a' * 40}"
_TWO = f"/package/00000000-0000-0000-0000-000000000002/{'b' * 40}"
_ART = f"/artifact/{'c' * 40}"
LINES = [
    _line(8, _ONE),
    _line(9, _ONE, "10.0.0.2"),
    "rubbish",
    _line(10, _ONE),
    _line(10, _TWO, "192.168.7.9"),
    _line(10, _ART),
    _line(11, _TWO),
    _line(11, "/meta"),
    "",
]
