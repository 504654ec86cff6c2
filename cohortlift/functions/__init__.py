"""Column expression builders."""
