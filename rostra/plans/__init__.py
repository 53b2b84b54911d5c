"""The catalogue of registered queries over the fixture tables, with DuckDB SQL."""
