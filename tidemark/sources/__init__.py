"""Reading: landed JSON, page sets, change ranges, lake tables, SQL files."""
