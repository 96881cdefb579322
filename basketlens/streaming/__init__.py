"""Message streams into RAW and MART tables."""
