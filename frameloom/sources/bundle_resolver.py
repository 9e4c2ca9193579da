"""Makes the media paths of this bundle's rows absolute: data/*.jsonl to runtime_data/*.jsonl. Needs Python only."""

import json
import sys
from pathlib import Path

#: Fields of a row that hold media.
MEDIA_FIELDS = ("images", "videos", "audios", "rejected_images", "rejected_videos", "rejected_audios")


def absolute(value, root: Path):
    if isinstance(value, list):
        return [absolute(v, root) for v in value]
    return value if value is None or Path(value).is_absolute() else str(root / value)


def main(root: Path) -> int:
    for source in sorted((root / "data").rglob("*.jsonl")):
        target = root / "runtime_data" / source.relative_to(root / "data")
        target.parent.mkdir(parents=True, exist_ok=True)
        with source.open(encoding="utf-8") as rows, target.open("w", encoding="utf-8", newline="\n") as out:
            for text in filter(str.strip, rows):
                row = json.loads(text)
                row.update({k: absolute(row[k], root) for k in MEDIA_FIELDS if k in row})
                out.write(json.dumps(row, ensure_ascii=False) + "\n")
    return 0


if __name__ == "__main__":
    sys.exit(main(Path(sys.argv[1]).resolve() if len(sys.argv) > 1 else Path(__file__).resolve().parent))
