"""Part of millrace."""
