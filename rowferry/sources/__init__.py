"""Sources: registered tables and SQL, databases over JDBC, folders of SQLite files."""
