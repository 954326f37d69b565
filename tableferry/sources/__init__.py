"""Where rows, messages and files come from, and where they are stored."""
