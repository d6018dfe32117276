"""A taxonomy over the words of the part table."""

from shelfmark.taxonomy import build

PARTS = build({
    "taxonomy": {
        "Fasteners": ["Rings", "Bolts", "Rods"],
        "Machines": ["Gears", "Plates", "Gizmos"],
        "Workshop": ["Anvils", "Widgets", "Cold Work"],
        "Languages": ["Python", "Rust", "Go", "Web Development"],
    },
    "keywords": {
        "Rings": ["ring", "rings"],
        "Bolts": ["bolt", "red bolt"],
        "Rods": ["rod"],
        "Gears": ["gear", "gear-box"],
        "Plates": ["plate"],
        "Gizmos": ["gizmo"],
        "Anvils": ["anvil", "fasteners"],
        "Widgets": ["widget", "toolkit"],
        "Cold Work": ["cold"],
    },
    "topics": {
        "Rings": ["ring", "PROMO"],
        "Gears": ["gear", "promo"],
        "Cold Work": ["small", "security"],
        "Plates": ["economy"],
    },
})
