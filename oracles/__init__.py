"""SQL twins of the queries.

``views.sql`` holds named views, the other files one statement per query. A block starts
with ``-- name: x`` and may list the views it needs in ``-- uses: a, b``.
"""

from __future__ import annotations

from pathlib import Path

HERE = Path(__file__).parent


def _blocks(path: Path) -> dict[str, tuple[list[str], str]]:
    blocks = {}
    for text in path.read_text(encoding="utf-8").split("-- name: ")[1:]:
        name, _, body = text.partition("\n")
        uses: list[str] = []
        if body.startswith("-- uses: "):
            line, _, body = body.partition("\n")
            uses = [u.strip() for u in line.removeprefix("-- uses: ").split(",")]
        blocks[name.strip()] = (uses, body.strip().rstrip(";"))
    return blocks


def load_oracles() -> dict[str, str]:
    views = _blocks(HERE / "views.sql")

    def needed(names: list[str], seen: list[str]) -> list[str]:
        for name in names:
            if name not in seen:
                needed(views[name][0], seen)
                seen.append(name)
        return seen

    statements = {}
    for path in sorted(HERE.glob("*.sql")):
        if path.name == "views.sql":
            continue
        for name, (uses, body) in _blocks(path).items():
            prelude = ",\n".join(f"{v} AS (\n{views[v][1]}\n)" for v in needed(uses, []))
            statements[name] = f"WITH {prelude}\n{body}" if prelude else body
    return statements
