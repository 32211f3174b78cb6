"""Result tables, exports and reports."""
