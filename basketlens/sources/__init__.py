"""Where rows come from: document folders, collections, message topics, tables, databases."""
