"""What pages say instead of content, and sentences of content that speak of such things. None is from the test tables.

The first two lists were looked at while the cues were chosen; the held-out ones were written afterwards and judged once.
"""

MESSAGES = (
    'The requested URL was not found on this server.',
    'JavaScript must be enabled to use this site',
    "Oops! That page can't be found.",
    'Sorry, you have been blocked',
    'Under construction',
    'Seite nicht gefunden',
    'Página no encontrada',
    'Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.',
    'Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat.',
    'You need to enable JavaScript to run this app.',
    '503 Service Temporarily Unavailable\nnginx',
    'Checking your browser before accessing example.com.',
    'Your connection was interrupted. A network change was detected.',
    "This page isn't working right now. HTTP ERROR 500",
    'Whoops, looks like something went wrong.',
    'The server encountered an internal error or misconfiguration and was unable to complete your request.',
    "You don't have permission to access this resource.",
    'Access to this page has been denied because we believe you are using automation tools to browse the website.',
    'The site is currently down for maintenance. Please check back soon.',
    'Application error: a client-side exception has occurred (see the browser console for more information).',
    'This video is unavailable.',
    "We're sorry, but this page doesn't work properly without JavaScript enabled. Please enable it to continue.",
    'Please turn on JavaScript in your browser and refresh the page.',
    'Error establishing a database connection',
    'The page you are looking for might have been removed, had its name changed, or is temporarily unavailable.',
    'Account suspended. Please contact your hosting provider.',
    '429 Too Many Requests. You have exceeded the rate limit.',
    'Invalid or expired session token. Please log in again.',
    'Verify you are human by completing the action below.',
    'TODO: write introduction',
    '[Content to be added]',
    'Insert your text here.',
    'This is placeholder content. Replace it with your own.',
    'This page intentionally left blank.',
    'Site im Aufbau. Schauen Sie bald wieder vorbei.',
    'Diese Seite existiert leider nicht.',
    'Ein unerwarteter Fehler ist aufgetreten. Bitte versuchen Sie es später erneut.',
    'Bitte schalten Sie JavaScript ein, um fortzufahren.',
    'Ha ocurrido un error inesperado. Vuelva a intentarlo más tarde.',
    'Necesita activar JavaScript para ver este sitio.',
    'Acceso prohibido.',
    'Une erreur est survenue. Veuillez réessayer plus tard.',
    'Page non trouvée',
    'Vous devez activer JavaScript pour utiliser cette application.',
    'Contenu à venir.',
    'Próximamente.',
    'Connection timed out. Error code 522',
    'Unable to load the page. Check your internet connection.',
    'Traceback (most recent call last):\nValueError: invalid literal',
    'asdf asdf asdf asdf',
    'Sample page. This is an example page.',
    'Sign in to continue',
    'This content is no longer available.',
    'Your IP address has been temporarily blocked due to unusual activity.',
    '404',
)

CONTENTS = (
    'The error handler writes every failed request to a log file and restarts the worker.',
    'When the server returns 404, the client removes the page from its index.',
    'JavaScript is a language that runs in browsers and on servers.',
    'Enable the plugin in the settings before you import the first project.',
    'A placeholder in a template is replaced with the value of the field of that name.',
    'The gateway accepts requests on port 8080 and forwards them to the backend.',
    'To debug a timeout, look at the trace of the slowest call and compare it with the others.',
    'Access is denied to accounts that have no role in the project, which keeps secrets safe.',
    'The function raises a ValueError if the input is empty.',
    'Die Fehlermeldung erklärt, welche Einstellung fehlt und wie man sie setzt.',
    "Le serveur renvoie une erreur quand la clé n'est pas valide, ce qui arrête la copie.",
    'Para activar el módulo, abra la configuración y elija la segunda opción.',
    'Our team is working on a new release with a faster parser.',
    'Write a short description of your project in the README file.',
    'Add the text to the footer and save the page.',
    'If the page is missing, create it in the docs folder and run the build again.',
    'This chapter describes error codes and what to do about each of them.',
    'Too many requests at once slow the server down, so clients should wait between calls.',
    'Scripts in the build folder run before each release and need a token.',
    'The maintenance window starts on Sunday and lasts two hours.',
    'Lorem ipsum is text used by printers since the sixteenth century.',
    'The test suite has a test for each endpoint.',
    'Coming back to the first example, the cache now holds two entries.',
    'The index page lists all guides in order of difficulty.',
    'Restart the service after you change the port.',
    'The build fails with exit code 2 if a link is broken.',
    'A blocked thread waits until the lock is free.',
    'Il file di configurazione contiene le chiavi del progetto e il nome del server.',
)

HELD_OUT_MESSAGES = (
    "Sorry, we couldn't find that page.",
    "The link you followed may be broken, or the page may have been removed.",
    "Forbidden. You don't have permission to access / on this server.",
    "Your browser does not support JavaScript.",
    "This application requires JavaScript.",
    "An error occurred while processing your request.",
    "Gateway Timeout",
    "Service Unavailable. The server is temporarily unable to service your request due to maintenance downtime.",
    "We'll be back soon! Our site is undergoing maintenance.",
    "Please verify that you are not a robot.",
    "You have been logged out. Please log in again.",
    "No results found.",
    "Coming soon",
    "Work in progress",
    "Text to be added",
    "Your content here",
    "Lorem ipsum",
    "Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur.",
    "Fehler: Verbindung zur Datenbank fehlgeschlagen.",
    "Diese Webseite ist zurzeit nicht verfügbar.",
    "Zu viele Anfragen. Bitte warten Sie einen Moment.",
    "La página solicitada no existe.",
    "El sitio está en mantenimiento.",
    "Se requiere JavaScript para continuar.",
    "Erreur interne du serveur.",
    "Cette page n'existe plus.",
    "Accès interdit",
    "Fatal error: Uncaught Exception in index on line 12",
    "Access Denied. Reference #18.2d1c",
    "Attention Required! Please complete the security check to access the site.",
)

HELD_OUT_CONTENTS = (
    "A 404 page should tell readers where to go next.",
    "The service restarts itself after an error and keeps its queue.",
    "Use the offline mode when the network is slow.",
    "The log shows which requests were denied and why.",
    "Scripts are loaded in the order in which the page names them.",
    "Each session ends after twenty minutes of silence.",
    "Fill in the form and send it to the registry by post.",
    "The example below adds two numbers and prints their sum.",
    "Most errors come from a missing comma in the settings file.",
    "This section is about themes, colours and fonts.",
    "Choose a name here that no other project has.",
    "The team found three ways to make the index smaller.",
    "Der Server antwortet mit einem Fehler, wenn der Schlüssel fehlt.",
    "Das Skript prüft jede Seite und meldet leere Absätze.",
    "El servidor guarda una copia de cada página encontrada.",
    "Le script lit la page et garde les liens trouvés.",
    "Humans and machines read the same manifest.",
    "An empty list means that nothing has changed.",
    "Later chapters return to the question of caching.",
    "Rate limits apply to each key separately.",
    "La temperatura media del mare aumenta ogni anno di pochi decimi.",
    "Dokumentasi ini menjelaskan cara memasang perangkat lunak baru.",
    "The author signs in once and then works without interruption.",
    "Tests that fail are listed at the end of the report.",
    "Blank lines separate paragraphs.",
)
