"""Rule packs: what classification and scoring look for, as data."""
