"""Operators for preparing training data; a self-contained subpackage that nothing else imports."""
