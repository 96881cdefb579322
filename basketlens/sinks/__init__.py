"""Where rows go: messages, monthly tables, exports."""
