"""DataFrame operators: dictionary rows, source packs, archive members, duplicates, classification, contracts."""
