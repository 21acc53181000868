"""Independent DuckDB SQL used as the correctness oracle for every plan."""
